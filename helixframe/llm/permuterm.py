"""Operator 12: words that differ by one character, found by permuterm rotations.

A word w of L characters, marked by a terminator t, has the rotations w[i:] t w[:i]. The rotation
behind the character at i ends in that character, so all but its end is the word with that place
skipped: words that differ there alone share this prefix, and a word that lacks the character has the
prefix as a whole rotation of its own. So every rotation is keyed twice, whole and without its end,
and rows are sorted by key and scanned: a group has at most one whole rotation and, at one place, one
word for each letter. It is never expanded into pairs: each member needs the group's counts and its
best two words. A word is counted near another once, though a character of a run can be removed at
several places: only the run's first place counts.

Words of more than LONG characters would take the square of their length as rotations; theirs are
keyed by digests of both sides of the skipped place (modulo a prime of 127 bits), which are linear.

Null texts hold no words; a null id is written as nothing. An empty table gives an empty result. Ties
in n go to the smallest word in code-point order. Words must not hold U+0000, the terminator; the
registered query's words are letters. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import crc_sql, keep, table, text_chunks

#: Longer words are keyed by digests.
LONG = 64
#: Distinct words that a task counts at a time, and characters of a text that are split at a time.
COUNTED, PIECE = 100_000, 1 << 20
TERMINATOR = "\x00"
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_PRIME, _BASE = (1 << 127) - 1, 0x9E3779B97F4A7C15F39CC0605CEDC835


def runs(text: str) -> Counter[str]:
    """The letter runs of a text, A-Z lower-cased, and their counts."""
    text = text.encode().lower().decode()  # of bytes, lower() changes A-Z alone
    if len(text) <= PIECE:
        return Counter(_RUN.findall(text))
    return Counter(m.group() for m in _RUN.finditer(text))


def vocabulary(docs: DataFrame, form: Callable[[int, str, str], str] | None = None, least: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the runs of all texts, changed by form(checksum of `<id>:<run>`, run), of at least least characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for begin, texts in text_chunks(batch, "text"):
                ids = batch.column(0).slice(begin, len(texts)).to_pylist()
                for doc, t in zip(ids, texts, strict=True):
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for w, n in runs(t).items():
                        w = form(zlib.crc32(w.encode(), start), w) if form else w
                        if len(w) >= least:
                            counted[w] += n
                    if len(counted) > COUNTED:
                        yield out()
                        counted.clear()
        if counted:
            yield out()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(key, skip, first, word, n): each rotation of (word, n), whole and, with skip, without the character at its end."""
    turned = words.filter(F.length("word") <= LONG).select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("cut"))
    word, cut = F.col("word"), F.col("cut")
    tail, before = F.substring(word, cut + 1, F.length(word)), F.col("cut") - 1
    last = F.substring(word, cut, F.lit(1))
    roles = F.array(
        F.when(cut > 0, F.struct(F.concat(tail, F.lit(TERMINATOR), F.substring(word, F.lit(1), before)).alias("key"), F.lit(True).alias("skip"), ((cut == 1) | (F.substring(word, before, F.lit(1)) != last)).alias("first"))),
        F.struct(F.concat(tail, F.lit(TERMINATOR), F.substring(word, F.lit(1), cut)).alias("key"), F.lit(False).alias("skip"), F.lit(False).alias("first")),
    )
    return turned.select("word", "n", F.inline(F.array_compact(roles))).select("key", "skip", "first", "word", "n")


def long_rotations(words: DataFrame) -> DataFrame:
    """The same of words of more than LONG characters, and whole ones of those of LONG, that share their key with another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in batch.column(0):
                w = w.as_py()
                after, ahead = [0], 0
                for c in reversed(w):
                    after.append((after[-1] * _BASE + ord(c) + 1) % _PRIME)
                after.reverse()
                keys, skips, firsts = [], [], []
                for i in range(len(w) + 1):
                    keys.append(b"%d:%x:%x" % (i, ahead, after[i]))
                    skips.append(False)
                    firsts.append(False)
                    if i < len(w):
                        if len(w) > LONG:
                            keys.append(b"%d:%x:%x" % (i, ahead, after[i + 1]))
                            skips.append(True)
                            firsts.append(i == 0 or w[i] != w[i - 1])
                        ahead = (ahead * _BASE + ord(w[i]) + 1) % _PRIME
                    if len(keys) > 50_000 or i == len(w):
                        digest = pa.array([b"%x:%x" % (len(w), after[0])] * len(keys))
                        yield pa.RecordBatch.from_arrays([pc.cast(pa.array(keys), pa.string()), pa.array(skips), pa.array(firsts), pc.cast(digest, pa.string())], names=["key", "skip", "first", "digest"])
                        keys, skips, firsts = [], [], []

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for w in batch.column(0):
                h = 0
                for c in reversed(w.as_py()):
                    h = (h * _BASE + ord(c) + 1) % _PRIME
                digests.append(f"{len(w.as_py()):x}:{h:x}")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.string())], names=["word", "n", "digest"])

    words = words.filter(F.length("word") >= LONG)
    keyed = words.select("word").mapInArrow(run, "key string, skip boolean, first boolean, digest string")
    shared = keyed.groupBy("key").agg(F.count_if("skip").alias("skips"), F.max(F.col("first")).alias("first"), F.min("skip").alias("all")).filter("skips > 1 or (first and not all)")
    return keyed.join(shared.select("key"), "key", "left_semi").join(words.mapInArrow(name, "word string, n long, digest string"), "digest").select("key", "skip", "first", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best: struct (less: -n, word)) of distinct words (word, n); best is null where no word is near."""
    rows = rotations(words).unionByName(long_rotations(words))
    group = Window.partitionBy("key")
    ranked = group.orderBy(F.desc("skip"), F.desc("n"), "word")
    every = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))
    skipped, whole = F.when(F.col("skip"), me), F.when(~F.col("skip"), me)
    scanned = rows.select(
        "word", "n", "skip", "first", F.row_number().over(ranked).alias("place"), F.count_if("skip").over(every).alias("skips"), F.count_if("first").over(every).alias("firsts"),
        F.first(skipped).over(every).alias("one"), F.nth_value(skipped, 2).over(every).alias("two"), F.last(whole).over(every).alias("whole"),
    ).filter((F.col("skips") > 1) | ((F.col("skips") > 0) & F.col("whole").isNotNull()))
    near = F.when(F.col("skip"), F.col("skips") - 1 + F.when(F.col("first") & F.col("whole").isNotNull(), 1).otherwise(0)).otherwise(F.col("firsts"))
    other = F.when(F.col("skip") & (F.col("place") == 1), F.col("two")).otherwise(F.col("one"))
    found = scanned.select("word", "n", near.alias("near"), F.when(F.col("skip"), F.least(other, "whole")).otherwise(other).alias("best"))
    none = F.lit(None).cast("struct<less: bigint, word: string>")
    joined = words.select("word", "n", F.lit(0).alias("near"), none.alias("best")).unionByName(found)
    return joined.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))


def forms(near: DataFrame, times: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n): the best near word, if it occurs times as often or more."""
    n = -F.col("best.less")
    common = n >= times * F.col("n")
    return near.select("word", "n", "n_near", F.when(common, F.col("best.word")).alias("form"), F.when(common, n).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """formed with root, the end of the chain of forms. Counts rise along a chain, so it has no ring; each round doubles the way gone."""
    gone = keep(formed.filter("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = gone.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = keep(gone.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "forms")
        if step.filter("moved").isEmpty():
            break
        gone = step.drop("moved")
    return formed.join(gone, "word", "left").withColumn("root", F.coalesce("root", "word"))


def drop_one(checksum: int, run: str) -> str:
    """The contract's variants: of one run in 31 the character at checksum modulo its length goes."""
    if checksum % 31:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def op12_permuterm_variants(spark, sf_dir: str) -> DataFrame:
    words = keep(vocabulary(table(spark, sf_dir, "documents"), drop_one).filter("n >= 2"), "words")
    formed = keep(forms(neighbours(words)), "formed")
    return roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE_SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
hashed AS (SELECT run, n, {crc_sql("line")} AS h FROM (SELECT run, count(*) AS n, concat(doc_id, ':', run) AS line FROM runs GROUP BY doc_id, run) t),
changed AS (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gaps AS (SELECT word, n, left(word, i) AS head, substr(word, i + 2) AS tail FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words) t),
less AS (SELECT g.word AS long, w.word AS short FROM gaps g JOIN words w ON w.word = g.head || g.tail),
near AS (SELECT x.word AS word, y.word AS other FROM gaps x JOIN gaps y ON x.head = y.head AND x.tail = y.tail AND x.word <> y.word UNION SELECT long, short FROM less UNION SELECT short, long FROM less),
best AS (SELECT near.word, w.word AS other, w.n, count(*) OVER (PARTITION BY near.word) AS n_near, row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, w.word) AS place FROM near JOIN words w ON w.word = near.other),
formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.other END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
chain AS (SELECT word, word AS root, form AS next FROM formed UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
