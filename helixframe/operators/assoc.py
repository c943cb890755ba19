"""Association tests, their metrics, and the tables behind plots."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.functions import expr as E
from helixframe.operators import logistic, quality, tiles
from helixframe.operators.tiles import Tiles
from helixframe.plans.stored import stored

GENOME_WIDE, SUGGESTIVE = 5e-8, 1e-5


def male_x(calls: DataFrame, variants: DataFrame, males: DataFrame) -> DataFrame:
    """calls (sid, vid, g) with males' haploid calls (0 or 1) on X counted as 0 or 2."""
    x = variants.filter("chrom = 'X'").select("vid", F.lit(True).alias("__x"))
    met = calls.join(x, "vid", "left").join(males.select("sid", F.lit(True).alias("__m")), "sid", "left")
    return met.select("sid", "vid", F.when(F.col("__x") & F.col("__m"), F.col("g") * 2).otherwise(F.col("g")).alias("g"))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with each column less its mean, over its standard deviation (n - 1); constant columns become 0."""
    stats = df.agg(*[e for i, c in enumerate(columns) for e in (F.avg(c).alias(f"__m{i}"), F.stddev_samp(c).alias(f"__s{i}"))])
    met = df.join(F.broadcast(stats))  # one row
    z = {c: F.when(F.col(f"__s{i}") > 0, (F.col(c) - F.col(f"__m{i}")) / F.col(f"__s{i}")).when(F.col(c).isNotNull(), 0.0) for i, c in enumerate(columns)}
    return met.withColumns(z).select(*df.columns)


def centered_square(df: DataFrame, c: str, name: str) -> DataFrame:
    """df with name: (x - mean)^2."""
    return df.join(F.broadcast(df.agg(F.avg(c).alias("__mean")))).withColumn(name, F.pow(F.col(c) - F.col("__mean"), F.lit(2.0))).drop("__mean")  # one row


def rank_inverse_normal(df: DataFrame, c: str, key: str, name: str) -> DataFrame:
    """df with name: the normal quantile of (rank - 3/8) / (n + 1/4) of c; equal values have their mean rank, NULL stays NULL."""
    per = ranked(df.filter(F.col(c).isNotNull()).select(F.col(c).alias("__v"), key), ["__v", key])
    mean = per.groupBy("__v").agg(F.avg("rank").alias("__r"))
    n = df.agg(F.count(c).alias("__n"))  # one row
    met = df.join(mean, F.col(c) == F.col("__v"), "left").join(F.broadcast(n))
    return met.withColumn(name, E.probit((F.col("__r") - 0.375) / (F.col("__n") + 0.25))).drop("__v", "__r", "__n")


def linear_assoc(calls: DataFrame, pheno: DataFrame, covariates: list[str] | None = None) -> DataFrame:
    """(vid, n, beta, se, t) of y on g, an intercept and covariates, over the samples that have them all and a call.

    One aggregate per variant sums the products of each two columns; without covariates columns solve them,
    with covariates NumPy does, a batch of variants at a time. Covariates should be standardized. y is taken
    less its rounded mean, so that squares of a trait far from zero keep their digits.
    """
    covariates = covariates or []
    g, y = F.col("g").cast("double"), F.col("y")
    whole = pheno.select("sid", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in covariates]).dropna()
    middle = whole.agg(F.coalesce(F.round(F.avg("y")), F.lit(0.0)).alias("__middle"))  # one row
    whole = whole.join(F.broadcast(middle)).withColumn("y", F.col("y") - F.col("__middle")).drop("__middle")
    met = calls.filter("g is not null").join(whole, "sid")
    n = F.col("n")
    if not covariates:
        s = met.groupBy("vid").agg(F.count(F.lit(1)).alias("n"), F.sum(g).alias("sg"), F.sum(y).alias("sy"), F.sum(g * g).alias("sgg"), F.sum(g * y).alias("sgy"), F.sum(y * y).alias("syy"))
        s = s.withColumns({"vgg": F.col("sgg") - F.col("sg") ** 2 / n, "vgy": F.col("sgy") - F.col("sg") * F.col("sy") / n, "vyy": F.col("syy") - F.col("sy") ** 2 / n})
        fit = s.filter((F.col("vgg") > 1e-9) & (n > 2)).withColumn("beta", F.col("vgy") / F.col("vgg"))
        fit = fit.withColumn("se", F.sqrt(F.greatest(F.col("vyy") - F.col("beta") * F.col("vgy"), F.lit(0.0)) / ((n - 2) * F.col("vgg"))))
        return fit.select("vid", "n", "beta", "se", F.when(F.col("se") > 0, F.col("beta") / F.col("se")).alias("t"))

    columns = [F.lit(1.0), *map(F.col, covariates), g, y]
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = met.groupBy("vid").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(columns[i] * columns[j]) for i, j in pairs]).alias("s"))

    @F.pandas_udf("beta double, se double")
    def solve(s: pd.Series, n: pd.Series) -> pd.DataFrame:
        flat = np.stack(s.to_numpy())
        m = np.empty((len(s), k, k))
        for at, (i, j) in enumerate(pairs):
            m[:, i, j] = m[:, j, i] = flat[:, at]
        # the Schur complement of intercept and covariates leaves the products of the residuals of g and y
        base, rest = m[:, :-2, :-2], m[:, :-2, -2:]
        left = m[:, -2:, -2:] - rest.transpose(0, 2, 1) @ (np.linalg.pinv(base, rcond=1e-10, hermitian=True) @ rest)
        gg, gy, yy, df = left[:, 0, 0], left[:, 0, 1], left[:, 1, 1], n.to_numpy() - (k - 1)
        fine = (gg > 1e-9) & (df > 0)
        beta = np.where(fine, gy / np.where(fine, gg, 1), np.nan)
        se = np.where(fine, np.sqrt(np.maximum(yy - beta * gy, 0) / np.where(fine, df * gg, 1)), np.nan)
        return pd.DataFrame({"beta": beta, "se": se})

    out = sums.select("vid", "n", solve("s", "n").alias("f")).select("vid", "n", "f.*").filter("beta is not null and not isnan(beta)")
    return out.withColumn("t", F.when(F.col("se") > 0, F.col("beta") / F.col("se")))


def _log_beta_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided tail of Student's t, by the continued fraction of the incomplete beta function."""
    from math import lgamma

    x, a, b = df / (df + t * t), df / 2, np.full_like(df, 0.5)
    swap = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)
    front = np.exp(a * np.log(np.maximum(x, 1e-300)) + b * np.log(np.maximum(1 - x, 1e-300)) - np.array([lgamma(i) + lgamma(j) - lgamma(i + j) for i, j in zip(a, b, strict=True)])) / a
    c, d = np.ones_like(x), 1 / np.where(np.abs(v := 1 - (a + b) * x / (a + 1)) < 1e-300, 1e-300, v)
    h = d.copy()
    for m in range(1, 200):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / np.where(np.abs(v := 1 + k * d) < 1e-300, 1e-300, v)
            c = np.where(np.abs(v := 1 + k / c) < 1e-300, 1e-300, v)
            h = h * c * d
    return np.where(swap, 1 - front * h, front * h)


@F.pandas_udf(T.DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    out = pd.Series(np.nan, t.index)
    ok = (t.notna() & (df > 0)).to_numpy()
    if ok.any():
        out[ok] = np.clip(_log_beta_tail(t[ok].to_numpy(float), df[ok].to_numpy(float)), 0, 1)
    return out.where(out.notna(), None)


def logistic_assoc(calls: DataFrame | Tiles, pheno: DataFrame, covariates: list[str] | None = None, rounds: int = 30) -> DataFrame:
    """(vid, n, beta, se, method) of a 0/1 trait on g and covariates: IRLS, or Firth's penalty where that diverges.

    The variants of a tile are fitted together.
    """
    return logistic.logistic(calls if isinstance(calls, Tiles) else tiles.tiled(calls), pheno, covariates or [], rounds)


def filter_test(raw: DataFrame, test: str = "ADD") -> DataFrame:
    """Rows of the wanted TEST term; without any, an error that names the terms there are. Tables without TEST pass."""
    column = next((c for c in raw.columns if c.upper() == "TEST"), None)
    if column is None:
        return raw
    kept = raw.filter(F.col(column) == test)
    if kept.isEmpty():
        terms = sorted(r[0] for r in raw.select(E.nullify(column)).distinct().limit(50).collect() if r[0])
        raise ValueError(f"no rows of test {test}; there are {', '.join(terms) or 'none'}")
    return kept


def normalize_sumstats(raw: DataFrame, trait: str, ancestry: str, build: str, test: str = "ADD") -> DataFrame:
    """The stable 18-column summary table from association output; PAR and XY count as X, odds ratios become log odds."""
    has = {c.upper(): c for c in raw.columns}

    def of(*names: str) -> Column:
        found = [E.nullify(has[n]) for n in names if n in has]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    numbers = {
        "a1_freq": of("A1_FREQ", "ALT_FREQS", "A1_FREQS"), "mac": of("MAC"), "info": of("MACH_R2", "INFO", "R2"), "n": of("OBS_CT", "N"), "beta": of("BETA"), "se": of("SE", "LOG(OR)_SE"), "odds_ratio": of("OR"), "p": of("P"), "log10p": of("LOG10P"),
    }
    words = {"chrom": of("#CHROM", "CHROM"), "pos": of("POS", "GENPOS"), "id": of("ID"), "ref": of("REF"), "alt": of("ALT"), "effect_allele": of("A1"), "test": of("TEST")}
    # cleaned, parsed and judged in three steps: what a step mentions several times, the step before has made once
    text = filter_test(raw, test).select(*[c.alias(n) for n, c in (words | numbers).items()])
    parsed = text.select(*words, *[E.decimal(n).alias(n) for n in numbers])
    whole = parsed.select(*words, *[E.bounded(n).alias(n) for n in numbers])
    return whole.select(
        F.lit(trait).alias("trait"), F.lit(ancestry).alias("ancestry"), F.lit(build).alias("build"), E.collapse_par("chrom").alias("chrom"), F.col("pos").try_cast("long").alias("pos"), "id", "ref", "alt", "effect_allele", "a1_freq", "mac", "info", "test",
        F.col("n").cast("long").alias("n"), F.coalesce("beta", F.ln("odds_ratio")).alias("beta"), "se", "odds_ratio", F.coalesce("p", F.pow(F.lit(10.0), -F.col("log10p"))).alias("p"),
    )


def valid_p() -> Column:
    return (F.col("p") > 0) & (F.col("p") <= 1)


def ranked(df: DataFrame, order: list, rank: str = "rank", total: str | None = None) -> DataFrame:
    """df with its place in the total order, and if named the number of rows: dealt by ranges, sorted and stored once, each range's size added to those after it.

    A row's number within its range is part of what is stored, so no window or second shuffle follows; only
    the ranges' sizes meet in one task. Give only the columns that are needed: all are stored.
    """
    parts = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)  # the upper bits are the partition's
    sizes = parts.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("m"))
    before = sizes.selectExpr("__part", "coalesce(sum(m) over (order by __part rows between unbounded preceding and 1 preceding), 0) as before", "sum(m) over () as every")
    met = parts.withColumn("__part", part).join(F.broadcast(before), "__part")
    local = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return met.select(*df.columns, (local + F.col("before")).alias(rank), *([F.col("every").alias(total)] if total else []))


#: Half the width of the band of quantiles around the middle that is ranked exactly, and the accuracy that finds it.
NEAR_MIDDLE, ACCURACY = 0.001, 10_000


def genomic_lambda(df: DataFrame) -> DataFrame:
    """(lambda): the middle chi-square of the valid p over its expectation; NULL if there is none.

    Approximate quantiles bound a thin band around the middle; the rows below it are counted, those in it are ranked.
    """
    p = df.filter(valid_p()).select("p")
    low, high = p.agg(F.percentile_approx("p", [0.5 - NEAR_MIDDLE, 0.5 + NEAR_MIDDLE], ACCURACY).alias("q")).first()[0] or (None, None)
    sizes = p.agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("p") < low).alias("below") if low is not None else F.lit(0).alias("below"))
    band = ranked(p.filter(F.col("p").between(low, high)) if low is not None else p.limit(0), ["p"]).join(F.broadcast(sizes))  # one row
    place = F.col("rank") + F.col("below")
    middle = band.filter((place == F.floor((F.col("m") + 1) / 2)) | (place == F.floor(F.col("m") / 2) + 1))
    return middle.agg((F.avg(E.chi2_quantile("p")) / E.CHI2_MEDIAN).alias("lambda"))


def assoc_metrics(df: DataFrame) -> DataFrame:
    """(metric, value) from one pass by raw label: counts, of the chromosomes 1-22 and of X, the smallest p, and the sample counts on X."""
    ok = F.coalesce(valid_p(), F.lit(False))
    n = F.when(F.col("n") > 0, F.col("n")) if "n" in df.columns else F.lit(None).cast("long")
    counts = {"total_variants": F.count(F.lit(1)), "valid_p": F.count_if(ok), "genome_wide": F.count_if(ok & (F.col("p") <= GENOME_WIDE)), "suggestive": F.count_if(ok & (F.col("p") <= SUGGESTIVE))}
    per = df.groupBy("chrom").agg(*[e.alias(k) for k, e in counts.items()], F.min(F.when(ok, F.col("p"))).alias("min_p"), F.min(n).alias("n_min"), F.max(n).alias("n_max"))
    per = per.withColumn("label", E.collapse_par("chrom"))  # a row per label
    x, autosome = F.coalesce(F.col("label") == "X", F.lit(False)), F.coalesce(F.col("label").isin(*map(str, range(1, 23))), F.lit(False))

    def total(name: str, where: Column = F.lit(True)) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(name))), F.lit(0)).cast("double")

    wide = per.agg(
        *[total(k).alias(k) for k in counts], total("total_variants", autosome).alias("autosomal_rows"), total("total_variants", x).alias("x_rows"),
        total("valid_p", autosome).alias("autosomal_valid_p"), total("valid_p", x).alias("x_valid_p"), F.min("min_p").alias("min_p"),
        F.min(F.when(x, F.col("n_min"))).cast("double").alias("x_samples_min"), F.max(F.when(x, F.col("n_max"))).cast("double").alias("x_samples_max"),
    )
    return wide.unpivot([], wide.columns, "metric", "value")


def run_metrics(df: DataFrame) -> DataFrame:
    """assoc_metrics with the inflation factor."""
    return assoc_metrics(df).unionByName(genomic_lambda(df).select(F.lit("lambda").alias("metric"), F.col("lambda").alias("value")))


def reconcile_metrics(df: DataFrame, given: DataFrame) -> DataFrame:
    """(metric, expected, found, problem): metrics (metric, value) that differ from the table's own, are missing or extra, and odd chromosome labels."""
    own = assoc_metrics(df).withColumnRenamed("value", "found")
    met = given.select("metric", F.col("value").cast("double").alias("expected"), F.lit(1).alias("g")).join(own.withColumn("o", F.lit(1)), "metric", "full_outer")
    problem = F.when(F.col("g").isNull(), "missing").when(F.col("o").isNull(), "extra").when(~F.col("expected").eqNullSafe(F.col("found")), "differs")
    labels = df.groupBy("chrom").agg(F.count(F.lit(1)).cast("double").alias("found")).filter(~F.coalesce(F.col("chrom").isin(*map(str, range(1, 23)), "X"), F.lit(False)))
    odd = labels.select(F.coalesce("chrom", F.lit("NA")).alias("metric"), F.lit(None).cast("double").alias("expected"), "found", F.lit("label").alias("problem"))
    return met.select("metric", "expected", "found", problem.alias("problem")).filter("problem is not null").unionByName(odd)


RARE_COLUMNS = ["lci", "uci", "aaf", "maf", "mac"]


def top_hits(df: DataFrame, n: int = 10, rare: bool = False) -> DataFrame:
    """The n smallest valid p, ties by input order (row_id); in rare mode with the interval and the frequencies."""
    hits = df.filter(valid_p()).orderBy("p", "row_id").limit(n)
    return hits.select("id", "chrom", "pos", "row_id", "p", *RARE_COLUMNS) if rare else hits


def qq_points(df: DataFrame) -> DataFrame:
    """Valid rows with rank, expected and observed -log10 p."""
    points = ranked(df.filter(valid_p()), ["p", "id"], total="m")
    a = F.when(F.col("m") <= 10, 0.375).otherwise(0.5)
    expected = E.minus_log10((F.col("rank") - a) / (F.col("m") + 1 - 2 * a))
    return points.withColumns({"expected": expected, "observed": E.minus_log10("p")}).drop("m")


def thin_qq(points: DataFrame, n: int, threshold: int = 10_000_000) -> DataFrame:
    return points.filter((F.col("rank") % 2 == 1) | (F.col("p") <= SUGGESTIVE)) if n > threshold else points


def thin_manhattan(df: DataFrame, n: int, threshold: int = 10_000_000) -> DataFrame:
    return ranked(df, ["p", "id"]).filter(F.col("rank") <= -(-n // 2)).drop("rank") if n > threshold else df


def manhattan_layout(df: DataFrame) -> DataFrame:
    """(chrom_key, max_pos, gap, offset, tick): where each chromosome starts on the plot's axis.

    Labels without a key of their own follow in alphabetical order, from 1001 on. Rows meet by raw label first;
    the few labels are keyed after that.
    """
    per = df.groupBy("chrom").agg(F.max("pos").alias("max_pos")).withColumn("label", E.normalize_chrom("chrom")).filter("label is not null")
    per = per.groupBy("label").agg(F.max("max_pos").alias("max_pos")).withColumn("known", E.chrom_key("label"))
    per = per.selectExpr("*", "coalesce(known, 1000 + row_number() over (partition by known is null order by label)) as chrom_key")  # a row per label
    per = per.groupBy("chrom_key").agg(F.max("max_pos").alias("max_pos")).selectExpr("*", "greatest(1000000.0D, 0.005D * max(max_pos) over ()) as gap")
    offset = F.expr("coalesce(sum(max_pos + gap) over (order by chrom_key rows between unbounded preceding and 1 preceding), 0.0D)")
    return per.withColumn("offset", offset).withColumn("tick", F.col("offset") + F.col("max_pos") / 2)


def lead_hits(df: DataFrame, p: float = GENOME_WIDE, window: int = 500_000, n: int = 8) -> DataFrame:
    """Greedy independent signals: by p, none within window of one already taken on its chromosome; the best n.

    Each signal is a pass over the strong rows for the best one that is left, so no chromosome's rows meet in one task.
    """
    strong = stored(df.filter(F.col("p") <= p).select("chrom", "pos", "id", "p"))
    taken: list = []
    while len(taken) < n:
        apart = reduce(lambda a, b: a & b, [(F.col("chrom") != t.chrom) | (F.abs(F.col("pos") - t.pos) > window) for t in taken], F.lit(True))
        best = strong.filter(apart).orderBy("p", "chrom", "pos", "id").limit(1).collect()
        if not best:
            break
        taken += best
    return df.sparkSession.createDataFrame(taken, strong.schema)


def mac_bin(mac: Column) -> Column:
    return F.when(mac <= 1, "1").when(mac <= 5, "2-5").when(mac <= 10, "6-10").when(mac <= 20, "11-20").otherwise(">20")


def mac_bins(stats: DataFrame) -> DataFrame:
    """(mac_bin, n) of rows with a valid p."""
    return stats.filter(valid_p()).groupBy(mac_bin(F.col("mac")).alias("mac_bin")).agg(F.count(F.lit(1)).alias("n"))


def stratified_qq(df: DataFrame, by: str = "mac_bin") -> DataFrame:
    """Rows of valid p with rank, and size of their bin. A bin may hold most rows, so ranks come from one global order."""
    ok = df.filter(valid_p())
    sizes = ok.groupBy(by).agg(F.count(F.lit(1)).alias("m"))
    before = sizes.selectExpr(by, "m", f"coalesce(sum(m) over (order by {by} rows between unbounded preceding and 1 preceding), 0) as before")  # a row per bin
    placed = ranked(ok, [by, "p", "id"]).join(F.broadcast(before), by)
    return placed.withColumn("rank", F.col("rank") - F.col("before")).drop("before")


def effect_frequency(df: DataFrame, binary: bool, threshold: int = 10_000_000) -> DataFrame:
    """Rows with 0 < maf <= 0.5 and y: the effect, as log2 odds for binary traits. Beyond threshold every second row by (maf, p), and all p <= 1e-5."""
    y = F.when(F.col("odds_ratio") > 0, F.log2("odds_ratio")) if binary else F.col("beta")
    rows = df.withColumn("y", y).filter((F.col("maf") > 0) & (F.col("maf") <= 0.5) & F.col("y").isNotNull())
    if rows.count() <= threshold:
        return rows
    return ranked(rows, ["maf", "p", "id"]).filter((F.col("rank") % 2 == 1) | (F.col("p") <= SUGGESTIVE)).drop("rank")


def htp_mac(htp: DataFrame, binary: bool, dosage: bool = False) -> DataFrame:
    """HTP rows with maf, mac and mac_bin: minor alleles counted from genotypes, or 2 N maf for dosages; bad rows raise (see htp_mac_problems)."""
    quality.require(htp_mac_problems(htp, binary, dosage), "rows without a sound allele count")
    return _with_mac(htp, binary, dosage).withColumn("mac_bin", mac_bin(F.col("mac")))


def _with_mac(htp: DataFrame, binary: bool, dosage: bool) -> DataFrame:
    controls = F.coalesce("num_controls", F.lit(0))
    called = F.col("num_cases") + controls
    alt = F.col("cases_het") + 2 * F.col("cases_alt") + (F.col("controls_het") + 2 * F.col("controls_alt") if binary else 0)
    genotyped = F.col("cases_ref") + F.col("cases_het") + F.col("cases_alt") + (F.col("controls_ref") + F.col("controls_het") + F.col("controls_alt") if binary else 0)
    maf = F.least(F.col("aaf"), 1 - F.col("aaf"))
    return htp.withColumns({"maf": maf, "called": called, "genotyped": genotyped, "mac": 2 * called * maf if dosage else F.least(alt, 2 * genotyped - alt).cast("double")})


def htp_mac_problems(htp: DataFrame, binary: bool, dosage: bool = False) -> DataFrame:
    """(name, problem) of rows with a valid p: frequency or sample count out of range, bad genotype counts, unequal totals, no minor allele."""
    names = ["cases_ref", "cases_het", "cases_alt", *(["controls_ref", "controls_het", "controls_alt"] if binary else [])]
    whole = reduce(lambda a, b: a & b, [F.coalesce((F.col(c) >= 0) & (F.col(c) == F.floor(F.col(c))), F.lit(False)) for c in names])
    expected = F.col("called") if binary else F.col("num_cases")
    problem = F.when(~F.coalesce(F.col("aaf").between(0, 1) & (F.col("called") > 0), F.lit(False)), "frequency")
    if not dosage:
        problem = problem.when(~whole, "counts").when(F.col("genotyped") != expected, "totals")
    problem = problem.when(~F.coalesce(F.col("mac") > 0, F.lit(False)), "mac")
    return _with_mac(htp.filter(valid_p()), binary, dosage).select("name", problem.alias("problem")).filter("problem is not null")
