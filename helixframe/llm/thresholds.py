"""Operator 11: quality rules whose cutoffs are chosen with a guarantee on false rejection.

Fixed rules come first: a document of under 50 words, or with more than half of its words in repeated
three-word windows, fails. For the others, every rule (a ratio of counts) has a grid of cutoffs from
lenient to strict. In each stratum (a language), labelled documents that pass the fixed rules are
split by a hash of their id. The tuning part gives a ladder of rule sets, each at least as strict as
the one before. The holdout part tests them in that order: with k of n good documents rejected, the
hypothesis that more than ALPHA of the stratum's good documents are rejected is dropped if
P(Binomial(n, ALPHA) <= k) <= DELTA / strata. Testing stops at the first that stands, so a stratum
needs no correction for its ladder, and Bonferroni's division corrects for the strata: with
probability 1 - DELTA no chosen rule set exceeds ALPHA anywhere. Of the certified sets the one that
catches most poor tuning documents is taken, ties the most lenient; where none is certified, all are kept.

Null texts count as empty and fail the fixed rules. A null stratum is one of its own. Labels other
than 0 and 1, labels of null ids and ids labelled both ways teach nothing; a label that repeats counts
once, documents that share a labelled id count each. Equal texts of a stratum have equal verdicts. An
empty table gives an empty result; without labels only the fixed rules reject. Texts are read whole;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import crc_mod, crc_sql, keep, table, text_chunks

#: Share of a stratum's good documents that may be rejected by the chosen cutoffs, and the chance of exceeding it in any stratum.
ALPHA, DELTA = 0.02, 0.05
#: One labelled document in so many tunes the ladder; the others are its holdout.
TUNING = 4
#: Steps of the ladder: (grid points back from the cutoff, share of good tuning documents that a rule may reject).
LADDER = ((2, 0.0), (1, 0.0), (0, 0.0), (0, 0.001), (0, 0.0025), (0, 0.005), (0, 0.01))
#: Bytes of a text whose words are held as objects at a time.
PIECE = 1 << 20
SPACES, SYMBOLS, CAPITALS = b" \t\n\x0b\x0c\r", b"#*$%&|<>", bytes(range(65, 91))
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


@dataclass(frozen=True)
class Rule:
    """Rejects where the ratio of two measures is at or beyond a cutoff; cutoffs run from lenient to strict."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[float, ...]

    def reach(self) -> Column:
        """Place of the most lenient cutoff that catches the document; their number if none does."""
        value = F.when(F.col(self.whole) > 0, F.col(self.part) / F.col(self.whole))
        falling = self.cutoffs[0] > self.cutoffs[-1]
        missed = [F.coalesce((value < c if falling else value > c).cast("int"), F.lit(1)) for c in self.cutoffs]
        return sum(missed[1:], missed[0])


def _grid(lenient: float, strict: float, points: int = 24) -> tuple[float, ...]:
    return tuple(round(lenient * (strict / lenient) ** (i / (points - 1)), 6) for i in range(points))


RULES = (
    Rule("symbols", "n_symbols", "word_chars", _grid(0.5, 0.004)),
    Rule("capitals", "n_capitals", "word_chars", _grid(0.95, 0.1)),
    Rule("repeated_words", "n_repeat_words", "n_words", _grid(0.5, 0.01)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", _grid(0.5, 0.01)),
    Rule("long_words", "word_chars", "n_words", _grid(20.0, 5.0)),
    Rule("short_words", "word_chars", "n_words", _grid(1.5, 5.0)),
)


def _words(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a piece at a time; pieces end at spaces."""
    begin = 0
    while begin < len(raw):
        end = min(begin + PIECE, len(raw))
        while end < len(raw) and raw[end] not in SPACES:
            end += 1
        yield raw[begin:end].split()
        begin = end


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words within three-word windows that occur twice or more; ids number the words by kind."""
    if len(ids) < 4:
        return 0
    pair = ids[:-2] * kinds + ids[1:-1]
    if kinds >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1]
    _, at, n = np.unique(pair * kinds + ids[2:], return_inverse=True, return_counts=True)
    twice = n[at] > 1
    within = np.zeros(len(ids), bool)
    for k in range(3):
        within[k : len(ids) - 2 + k] |= twice
    return int(within.sum())


def measure(text: str) -> tuple[int, ...]:
    """The counts of MEASURES."""
    raw = text.encode()
    number: dict[bytes, int] = defaultdict(count().__next__)
    ids = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in _words(raw)]
    ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    held = lambda kinds: len(raw) - len(raw.translate(None, kinds))
    return len(ids), len(text) - held(SPACES), held(SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids, len(number)), len(lines), held(CAPITALS)


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """(key, stratum, counts of MEASURES, base_failed) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch, "text"):
                found = np.array([measure(t) for t in texts], np.int64).T
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(x) for x in found]], names=["key", "stratum", *MEASURES])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.concat(F.lit("="), F.col(stratum)), F.lit("")).alias("stratum"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, "key long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES))
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed from its largest term until the terms no longer count."""
    if k >= n:
        return 1.0
    up = k > n * p  # then the upper tail, from k + 1, is the one that falls
    i = k + 1 if up else k
    term = math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    total = 0.0
    while term > total * 1e-17 and 0 <= i <= n:
        total += term
        term *= (n - i) / (i + 1) * p / (1 - p) if up else i / (n - i + 1) * (1 - p) / p
        i += 1 if up else -1
    return 1 - total if up else min(1.0, total)


def upper_bound(k: int, n: int, miss: float) -> float:
    """The exact (Clopper-Pearson) upper confidence bound of a share of which k of n were seen."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_tail(k, n, mid) > miss else (low, mid)
    return high


def ladder(reached: pd.DataFrame, rules: int, steps=LADDER) -> list[list[int]]:
    """Of each step the cutoff's place by rule (-1: off), from tuning counts (rule, reach, good, poor) of one stratum.

    A rule that catches no poor document at its cutoff stays off.
    """
    n_good = reached.loc[reached["rule"] == 0, "good"].sum()
    out = []
    for back, share in steps:
        places = []
        for r in range(rules):
            own = reached[reached["rule"] == r].sort_values("reach")
            over = own[own["good"].cumsum() > share * n_good]["reach"]
            place = min(int(over.min()) if len(over) else len(RULES[r].cutoffs), len(RULES[r].cutoffs)) - 1 - back
            places.append(max(place, -1) if own.loc[own["reach"] <= place, "poor"].sum() else -1)
        out.append([max(a, b) for a, b in zip(places, out[-1], strict=True)] if out else places)
    return out


def choose(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, step, places, n_good, n_rejected, bound) of each stratum whose first step is certified. Few rows: strata, never documents."""
    marks = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).cast("long").alias("key")).agg(F.min(label).alias("good"), F.max(label).alias("most")).filter("good = most").drop("most")
    known = measured.filter("not base_failed").select("key", "stratum", F.array(*[r.reach() for r in RULES]).alias("reach")).join(marks, "key")
    known = keep(known.withColumn("tuning", F.coalesce(crc_mod("key", TUNING) == 0, F.lit(False))), "labelled")
    strata = max(1, known.select("stratum").distinct().count())
    reached = known.filter("tuning").select("stratum", "good", F.posexplode("reach").alias("rule", "reach")).groupBy("stratum", "rule", "reach").agg(F.sum("good").cast("long").alias("good"), F.sum(1 - F.col("good")).cast("long").alias("poor"))

    def climb(frame: pd.DataFrame) -> pd.DataFrame:  # at most one row a rule and cutoff
        return pd.DataFrame({"stratum": [frame["stratum"].iloc[0]], "steps": [ladder(frame, len(RULES))]})

    steps = keep(reached.groupBy("stratum").applyInPandas(climb, "stratum string, steps array<array<int>>"), "ladders")
    judged = known.join(steps, "stratum").select("stratum", "good", "tuning", F.posexplode(F.transform("steps", lambda places: _beyond(places))).alias("step", "rejected"))
    counted = judged.groupBy("stratum", "step").agg(
        F.count_if(~F.col("tuning") & (F.col("good") == 1)).alias("n_good"), F.count_if(~F.col("tuning") & (F.col("good") == 1) & F.col("rejected")).alias("n_rejected"),
        F.count_if(F.col("tuning") & (F.col("good") == 0) & F.col("rejected")).alias("caught"),
    )

    def certify(frame: pd.DataFrame) -> pd.DataFrame:  # one row a step
        best = None
        for r in frame.sort_values("step").itertuples():
            if binomial_tail(r.n_rejected, r.n_good, alpha) > delta / strata or not r.n_good:
                break
            best = r if best is None or r.caught > best.caught else best
        if best is None:
            return frame[["stratum", "step", "n_good", "n_rejected"]].iloc[:0].assign(bound=0.0)
        return pd.DataFrame([(best.stratum, best.step, best.n_good, best.n_rejected, upper_bound(best.n_rejected, best.n_good, delta / strata))], columns=["stratum", "step", "n_good", "n_rejected", "bound"])

    chosen = counted.groupBy("stratum").applyInPandas(certify, "stratum string, step int, n_good long, n_rejected long, bound double")
    return keep(chosen.join(steps, "stratum").select("stratum", "step", F.col("steps")[F.col("step")].alias("places"), "n_good", "n_rejected", "bound"), "cutoffs")


def _beyond(places: Column) -> Column:
    """True where a rule's cutoff catches the row's reach."""
    return F.exists(F.zip_with(F.col("reach"), places, lambda a, b: a <= b), lambda x: x)


def judge(measured: DataFrame, chosen: DataFrame) -> DataFrame:
    """measured with kept, the rule sets' step (null: none certified), and the rules that reject a document."""
    rows = measured.withColumn("reach", F.array(*[r.reach() for r in RULES])).join(chosen.select("stratum", "step", "places", "bound"), "stratum", "left")
    hit = F.array_compact(F.array(*[F.when(F.col("reach")[i] <= F.col("places")[i], F.lit(r.name)) for i, r in enumerate(RULES)]))
    rows = rows.withColumn("rules", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(hit))
    return rows.withColumn("kept", F.size("rules") == 0).drop("reach", "places")


def op11_risk_thresholds(spark, sf_dir: str) -> DataFrame:
    measured = keep(measures(table(spark, sf_dir, "documents")), "measures")  # counts alone: texts are read once
    out = judge(measured, choose(measured, table(spark, sf_dir, "labels")))
    return out.select(F.col("key").alias("doc_id"), *MEASURES[:5], "base_failed", "kept", "step", "bound", F.array_join("rules", ",").alias("rules"))


def oracle_sql(alpha: float = ALPHA, delta: float = DELTA) -> str:
    spaces = r"\x20\x09-\x0D"

    def held(kinds: str) -> str:
        return f"length(t) - length(regexp_replace(t, '[{kinds}]', '', 'g'))"

    def reach(i: int, r: Rule) -> str:
        missed = "<" if r.cutoffs[0] > r.cutoffs[-1] else ">"
        value = f"CAST({r.part} AS DOUBLE) / {r.whole}"
        return f"CASE WHEN {r.whole} > 0 THEN {' + '.join(f'CAST({value} {missed} {c} AS INT)' for c in r.cutoffs)} ELSE {len(r.cutoffs)} END"

    def tail(p: str) -> str:
        return f"list_sum(list_transform(range(k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - CASE WHEN n > i THEN lgamma(n - i + 1) ELSE 0 END + i * ln({p}) + (n - i) * ln(1 - {p}))))"

    steps = ", ".join(f"({i}, {back}, {share})" for i, (back, share) in enumerate(LADDER))
    names = ", ".join(f"'{r.name}'" for r in RULES)
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT id, regexp_extract_all(t, '[^{spaces}]+') AS w FROM d),
windows AS (SELECT id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS three FROM (SELECT id, w, unnest(range(len(w) - 2)) AS i FROM w) x),
twice AS (SELECT id, i, count(*) OVER (PARTITION BY id, three) AS n FROM windows),
within AS (SELECT id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) z WHERE n > 1 GROUP BY id),
lines AS (SELECT id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{spaces}]')) AS l FROM d),
m AS (SELECT d.id, doc_id, stratum, len(w) AS n_words, length(regexp_replace(t, '[{spaces}]', '', 'g')) AS word_chars, {held("#*$%&|<>")} AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
  coalesce(within.n, 0) AS n_repeat_words, len(l) AS n_lines, {held("A-Z")} AS n_capitals FROM d JOIN w USING (id) JOIN lines USING (id) LEFT JOIN within USING (id)),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [{', '.join(reach(i, x) for i, x in enumerate(RULES))}] AS reach FROM m),
marks AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
known AS (SELECT id, stratum, good, reach, {crc_sql('CAST(doc_id AS VARCHAR)')} % {TUNING} = 0 AS tuning FROM r JOIN marks USING (doc_id) WHERE NOT base_failed),
reached AS (SELECT stratum, good, unnest(range(1, {len(RULES) + 1})) AS rule, unnest(reach) AS reach FROM known WHERE tuning),
goods AS (SELECT stratum, count(*) FILTER (WHERE good = 1) AS every FROM known WHERE tuning GROUP BY stratum),
places AS (SELECT stratum, rule, p, count(*) FILTER (WHERE good = 1 AND reach <= p) AS good, count(*) FILTER (WHERE good = 0 AND reach <= p) AS poor FROM reached, (SELECT unnest(range({len(RULES[0].cutoffs)})) AS p) z GROUP BY ALL),
ladder(step, back, share) AS (VALUES {steps}),
raw AS (SELECT stratum, rule, step, greatest(coalesce(max(p) FILTER (WHERE good <= share * every), -1) - first(back), -1) AS place FROM places JOIN goods USING (stratum), ladder GROUP BY stratum, rule, step),
used AS (SELECT raw.stratum, raw.rule, step, CASE WHEN coalesce(poor, 0) > 0 THEN place ELSE -1 END AS place FROM raw LEFT JOIN places q ON q.stratum = raw.stratum AND q.rule = raw.rule AND q.p = place),
climbed AS (SELECT stratum, rule, step, max(place) OVER (PARTITION BY stratum, rule ORDER BY step) AS place FROM used),
sets AS (SELECT stratum, step, list(place ORDER BY rule) AS places FROM climbed GROUP BY stratum, step),
judged AS (SELECT stratum, step, good, tuning, len(list_filter(range(1, {len(RULES) + 1}), lambda i: reach[i] <= places[i])) > 0 AS hit FROM known JOIN sets USING (stratum)),
counts AS (SELECT stratum, step, count(*) FILTER (WHERE NOT tuning AND good = 1) AS n, count(*) FILTER (WHERE NOT tuning AND good = 1 AND hit) AS k, count(*) FILTER (WHERE tuning AND good = 0 AND hit) AS caught FROM judged GROUP BY stratum, step),
tested AS (SELECT *, bool_and(n > 0 AND {tail(str(alpha))} <= {delta} / (SELECT count(DISTINCT stratum) FROM known)) OVER (PARTITION BY stratum ORDER BY step) AS certified FROM counts),
chosen AS (SELECT stratum, step, n, k FROM tested WHERE certified QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY caught DESC, step) = 1),
halved AS (SELECT stratum, n, k, CAST(k AS DOUBLE) / n AS low, CAST(1 AS DOUBLE) AS high, 0 AS round FROM chosen
  UNION ALL SELECT stratum, n, k, CASE WHEN over THEN (low + high) / 2 ELSE low END, CASE WHEN over THEN high ELSE (low + high) / 2 END, round + 1 FROM (SELECT *, {tail('((low + high) / 2)')} > {delta} / (SELECT count(DISTINCT stratum) FROM known) AS over FROM halved WHERE round < 60) h),
cut AS (SELECT c.stratum, CAST(c.step AS INT) AS step, places, CASE WHEN c.k >= c.n THEN 1 ELSE high END AS bound FROM chosen c JOIN sets USING (stratum, step) JOIN halved h ON h.stratum = c.stratum AND h.round = 60),
last AS (SELECT r.*, step, bound, CASE WHEN base_failed THEN ['base'] ELSE [x FOR x, i IN [{names}] IF reach[i] <= places[i]] END AS rules FROM r LEFT JOIN cut USING (stratum))
SELECT doc_id, {', '.join(f'CAST({x} AS BIGINT) AS {x}' for x in MEASURES[:5])}, base_failed, coalesce(len(rules), 0) = 0 AS kept, step, bound, coalesce(array_to_string(rules, ','), '') AS rules FROM last"""


ORACLE_SQL = oracle_sql()
