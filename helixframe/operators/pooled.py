"""Principal components, covariates, the pooled score test, and rows of the pooled and rare-variant tables.

Matrices stay in Spark; only products whose sides are the number of components or covariates reach the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.functions import expr as E
from helixframe.operators import genotype, samples, subspace, variants
from helixframe.plans.stored import stored


class Components(NamedTuple):
    scores: DataFrame  # (sid, pc, score)
    weights: DataFrame  # (vid, pc, w)
    freqs: DataFrame  # (vid, p)


def _products(df: DataFrame, names: list[str]) -> np.ndarray:
    """The sums of products of each two columns: a matrix as small as their number."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = df.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
    out = np.zeros((len(names), len(names)))
    for (i, j), v in zip(pairs, row, strict=True):
        out[i, j] = out[j, i] = v or 0.0
    return out


def _times(names: list[str], matrix: np.ndarray) -> list[Column]:
    """The columns multiplied by matrix, named q0, q1, ..."""
    return [reduce(lambda a, b: a + b, [F.col(n) * float(matrix[i, j]) for i, n in enumerate(names)]).alias(f"q{j}") for j in range(matrix.shape[1])]


def _orthonormal(df: DataFrame, key: str, names: list[str]) -> tuple[DataFrame, list[str]]:
    """(key, q0, q1, ...) that span the columns of df; directions without length go."""
    values, vectors = np.linalg.eigh(_products(df, names))
    some = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
    matrix = vectors[:, some] / np.sqrt(values[some])
    return df.select(key, *_times(names, matrix)), [f"q{j}" for j in range(matrix.shape[1])]


def _components(calls: DataFrame, members: DataFrame, k: int, rounds: int, extra: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stratum, sid, pc, score), (stratum, vid, pc, w) and (stratum, vid, p) of calls (sid, vid, g) within members (stratum, sid); all strata are fitted at once."""
    x = subspace.matrix(calls, members, k + extra)
    y = x.people
    for _ in range(rounds):
        y = subspace.product(x, y, subspace.spanning(x, y))
    turns = subspace.spanning(x, y)
    found = {}
    for s, m in subspace.crossed(x, y, subspace.product(x, y, turns)).items():
        m = turns[s].T @ m
        values, vectors = np.linalg.eigh((m + m.T) / 2)
        best = np.argsort(values)[::-1][:k]
        found[s] = np.where(values[best] > 1e-10, values[best], 0), turns[s] @ vectors[:, best]
    signs = {s: np.where(c < 0, -1.0, 1.0) for s, c in subspace.cubes(y, {s: vec * (val > 0) for s, (val, vec) in found.items()}).items()}
    signed = {s: vec * (val > 0) * signs[s] for s, (val, vec) in found.items()}
    inverse = {s: signed[s] / np.sqrt(np.where(val > 0, val, 1)) for s, (val, _) in found.items()}
    counts = {s: int((val > 0).sum()) for s, (val, _) in found.items()}
    return subspace.by_sample(x, y, signed, counts), subspace.by_variant(x, y, inverse, counts), subspace.frequencies(x)


def fit_pca(calls: DataFrame, k: int = 10, rounds: int = 8, extra: int = 8) -> Components:
    """Components of standardised genotypes by randomised subspace iteration; missing calls count as the mean.

    A round is one pass over the calls, see subspace. Signs: the cubes of a component's scores sum to no less than 0.
    """
    return Components(*[d.drop("stratum") for d in _components(calls, calls.select(F.lit(0).alias("stratum"), "sid").distinct(), k, rounds, extra)])


def stratum_pca(calls: DataFrame, strata: DataFrame, k: int = 10, rounds: int = 8) -> DataFrame:
    """(stratum, sid, pc, score): a fit within each of the strata (sid, stratum), all at once."""
    return _components(calls, strata.filter("stratum is not null").select("stratum", "sid"), k, rounds, 8)[0]


def combine_pcs(parts: dict[str, DataFrame]) -> DataFrame:
    """The tables of components (sid, PC1, ...) of several strata, with the stratum; components that one lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [d.withColumn("stratum", F.lit(label)) for label, d in parts.items()])


def wide_pcs(scores: DataFrame, k: int) -> DataFrame:
    """(sid, PC1, ..., PCk) of long scores (sid, pc, score)."""
    return scores.groupBy("sid").pivot("pc", [f"PC{i + 1}" for i in range(k)]).agg(F.first("score"))


def _erfc(z: np.ndarray) -> np.ndarray:
    """The complementary error function of numbers from 0 on: its series up to 2, its continued fraction beyond."""
    square, out = z * z, np.empty_like(z)
    low = z < 2
    term = total = 2 / np.sqrt(np.pi) * z[low] * np.exp(-square[low])
    for n in range(1, 60):
        term = term * 2 * square[low] / (2 * n + 1)
        total = total + term
    out[low] = 1 - total
    high = z[~low]
    fraction = high.copy()
    for n in range(120, 0, -1):
        fraction = high + n / 2 / fraction
    out[~low] = np.exp(-square[~low]) / np.sqrt(np.pi) / fraction
    return out


@F.pandas_udf(T.DoubleType())
def chi2_tail(x: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    out = pd.Series(np.nan, x.index)
    known = x.notna().to_numpy()
    out[known] = _erfc(np.sqrt(np.maximum(x[known].to_numpy(float), 0) / 2))
    return out.where(out.notna(), None)


def pooled_assoc(calls: DataFrame, variants: DataFrame, pheno: DataFrame, covariates: list[str], loco: DataFrame | None = None, min_mac: float = 0, min_info: float = 0) -> DataFrame:
    """(vid, n, beta, se, chi2, p): score test of y, less the offset of the variant's chromosome, given covariates.

    pheno (sid, y, covariates...) is cut to complete cases; loco is (sid, chrom, pred). A missing call counts as the
    variant's mean; min_info cuts the ratio of the dosages' variance to its expectation. All sums come from one aggregate per variant.
    """
    whole = stored(pheno.select("sid", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in covariates]).dropna())
    means = whole.agg(F.count(F.lit(1)), *[F.avg(c) for c in covariates]).first()
    centred = whole.select("sid", *[(F.col(c) - float(m or 0)).alias(c) for c, m in zip(covariates, means[1:], strict=True)])
    q, names = _orthonormal(centred, "sid", covariates) if covariates else (centred, [])
    chroms = variants.select("chrom").distinct()
    y = whole.select("sid", "y").join(F.broadcast(chroms))  # a row per chromosome: some two dozen
    if loco is not None:
        y = y.join(loco.select("sid", "chrom", "pred"), ["sid", "chrom"], "left").select("sid", "chrom", (F.col("y") - F.coalesce("pred", F.lit(0.0))).alias("y"))
    rows = y.join(q, "sid")
    fitted = rows.groupBy("chrom").agg(F.avg("y").alias("mean"), *[F.sum(F.col("y") * F.col(c)).alias(f"b_{c}") for c in names])
    explained = reduce(lambda a, b: a + b, [F.col(c) * F.col(f"b_{c}") for c in names], F.col("mean"))
    residuals = rows.join(F.broadcast(fitted), "chrom").select("sid", "chrom", (F.col("y") - explained).alias("r"), *names)
    noise = residuals.groupBy("chrom").agg((F.sum(F.col("r") ** 2) / (means[0] - len(names) - 1)).alias("s2"))
    g = F.col("g").cast("double")
    met = calls.filter("g is not null").join(variants.select("vid", "chrom"), "vid").join(residuals, ["sid", "chrom"])
    sums = met.groupBy("vid", "chrom").agg(
        F.count(F.lit(1)).alias("n"), F.avg(g).alias("m"), F.sum(g * g).alias("gg"), F.sum("r").alias("r"), F.sum(g * F.col("r")).alias("gr"),
        *[e for c in names for e in (F.sum(c).alias(f"s_{c}"), F.sum(g * F.col(c)).alias(f"g_{c}"))],
    )
    m, n = F.col("m"), F.col("n")
    score = F.col("gr") - m * F.col("r")
    spread = reduce(lambda a, b: a - b, [(F.col(f"g_{c}") - m * F.col(f"s_{c}")) ** 2 for c in names], F.col("gg") - n * m * m)
    info = (F.col("gg") / n - m * m) / (m * (1 - m / 2))
    tested = sums.filter((F.least(n * m, n * (2 - m)) >= min_mac) & (F.coalesce(info, F.lit(0.0)) >= min_info)).join(F.broadcast(noise), "chrom").withColumns({"u": score, "v": spread}).filter("v > 1e-9")
    out = tested.select("vid", "n", (F.col("u") / F.col("v")).alias("beta"), F.sqrt(F.col("s2") / F.col("v")).alias("se"), (F.col("u") ** 2 / (F.col("s2") * F.col("v"))).alias("chi2"))
    return out.withColumn("p", chi2_tail("chi2"))


def htp_rows(calls: DataFrame, variants: DataFrame, status: DataFrame, assoc: DataFrame, trait: str, cohort: str = "cohort", model: str = "ADD") -> DataFrame:
    """The 22-column rows of assoc (vid, beta, se, p): odds ratios with their interval, counts by status (sid, case).

    variants has vid, chrom, pos, ref and alt. One aggregate per variant counts each genotype for cases and controls.
    """
    met = calls.filter("g is not null").join(status, "sid")
    named = {"Cases": F.col("case") == 1, "Controls": F.col("case") == 0}
    counts = [e for side, ok in named.items() for e in (F.count_if(ok).alias(f"Num_{side}"), *[F.count_if(ok & (F.col("g") == g)).alias(f"{side}_{kind}") for g, kind in enumerate(("Ref", "Het", "Alt"))])]
    per = met.groupBy("vid").agg((F.sum("g") / (2 * F.count("g"))).alias("AAF"), *counts)
    half = 1.959963984540054 * F.col("se")
    return per.join(variants, "vid").join(assoc.select("vid", "beta", "se", F.col("p").alias("Pval")), "vid").select(
        E.cpra("chrom", "pos", "ref", "alt").alias("Name"), F.col("chrom").alias("Chr"), F.col("pos").alias("Pos"), F.col("ref").alias("Ref"), F.col("alt").alias("Alt"),
        F.lit(trait).alias("Trait"), F.lit(cohort).alias("Cohort"), F.lit(model).alias("Model"), F.exp("beta").alias("Effect"), F.exp(F.col("beta") - half).alias("LCI_Effect"), F.exp(F.col("beta") + half).alias("UCI_Effect"),
        "Pval", "AAF", *[f"{n}" for side in named for n in (f"Num_{side}", f"{side}_Ref", f"{side}_Het", f"{side}_Alt")],
        F.format_string("BETA=%.6f;SE=%.6f;SCORE=%.6f", F.col("beta"), F.col("se"), F.col("beta") / (F.col("se") * F.col("se"))).alias("Info"),
    )


#: A dosage within this of a whole number is that hard call.
HARD_CALL = 0.1


def rare_target(calls: DataFrame, v: DataFrame, keep: DataFrame, targets: DataFrame, n_targets: int | None = None, max_missing: float = 0.05, mac: float = 1, mode: str = "hardcall", info_min: float = 0.8) -> DataFrame:
    """(vid, id, mac) of the kept samples' variants within targets (0-based half-open), named by position and alleles; with mode 'dosage' (vid, id, mac, r2).

    'hardcall' erases dosages: one that is near no whole number is no call. 'dosage' keeps them, and of the
    variants those whose MaCH R2 is from info_min to 2.
    """
    if mode not in ("hardcall", "dosage"):
        raise ValueError(f"the genotype mode is hardcall or dosage, not {mode}")
    inside = variants.in_intervals(v, targets, zero_based=True)
    chosen = calls.join(keep.select("sid"), "sid", "left_semi").join(inside.select("vid"), "vid", "left_semi")
    if mode == "hardcall" and calls.schema["g"].dataType.typeName() in ("float", "double", "decimal"):
        whole = F.round("g")
        chosen = chosen.withColumn("g", F.when(F.abs(F.col("g") - whole) <= HARD_CALL, whole))
    counts = genotype.allele_counts(chosen)
    passed = counts.filter((F.col("mac") >= mac) & (F.col("missing") / (F.col("n") + F.col("missing")) <= max_missing))
    if mode == "dosage":
        passed = genotype.mach_r2(passed).filter(F.col("r2").between(info_min, 2.0))
    return inside.join(passed, "vid").select("vid", E.cpra("chrom", "pos", "ref", "alt").alias("id"), "mac", *(["r2"] if mode == "dosage" else []))


class SexChecked(NamedTuple):
    detail: DataFrame  # (sid, sex, ped_sex, f, y_called, genetic, status)
    keep: DataFrame
    remove: DataFrame


def sex_markers(v: DataFrame, calls: DataFrame, build: str, maf: float = 0.05, max_missing: float = 0.05, window: int | None = None, r2: float = 0.2) -> DataFrame:
    """(vid, chrom): common, well called variants of X outside the pseudo-autosomal regions (pruned within window) and of Y."""
    placed = variants.split_par(v, build).filter("chrom in ('X', 'Y')").select("vid", "chrom", "pos")
    on = calls.join(placed.select("vid"), "vid", "left_semi")
    x = placed.filter("chrom = 'X'")
    kept = genotype.allele_counts(on.join(x.select("vid"), "vid", "left_semi")).filter((F.col("maf") >= maf) & (F.col("missing") / (F.col("n") + F.col("missing")) <= max_missing))
    x = x.join(kept.select("vid"), "vid", "left_semi")
    if window is not None:
        x = x.join(genotype.ld_prune(on, x, window, r2), "vid", "left_semi")
    return x.select("vid", "chrom").unionByName(placed.filter("chrom = 'Y'").select("vid", "chrom"))


class SexLimits(NamedTuple):
    """Female up to the first limit, male from the second, of F on X and of the share of called Y markers (not looked at where null)."""

    female: float = 0.2
    male: float = 0.8
    female_y: float | None = None
    male_y: float | None = None


def sex_limits(max_female_xf=None, min_male_xf=None, max_female_yrate=None, min_male_yrate=None) -> SexLimits:
    """Limits as configured: blank ones are not set, none at all are the defaults; those of X, and those of Y, come in pairs."""
    given = {"max_female_xf": max_female_xf, "min_male_xf": min_male_xf, "max_female_yrate": max_female_yrate, "min_male_yrate": min_male_yrate}
    found = {}
    for name, value in given.items():
        if value is not None and str(value).strip():
            try:
                found[name] = float(value)
            except ValueError:
                raise ValueError(f"{name} is no number: {value}") from None
    if not found:
        return SexLimits()
    if not {"max_female_xf", "min_male_xf"} <= found.keys():
        raise ValueError("custom limits need both max_female_xf and min_male_xf")
    if ("max_female_yrate" in found) != ("min_male_yrate" in found):
        raise ValueError("limits of the Y rate need both max_female_yrate and min_male_yrate")
    return SexLimits(*(found.get(n) for n in given))


def sex_check(calls: DataFrame, manifest: DataFrame, action: str = "warn", female: float = 0.2, male: float = 0.8, markers: DataFrame | None = None, limits: SexLimits | None = None, enabled: bool = True, allow_no_x: bool = False) -> SexChecked:
    """Sex from inbreeding on X calls: 2 up to the first limit, 1 from the second, else 0; y_called is the share of Y markers with a call.

    calls are those of sex_markers (vid, chrom), or of X alone without them. manifest is (sid, sex,
    ped_sex); action 'exclude' removes mismatches, 'fail' raises on them. With limits of the Y rate, both
    rates must agree. Where the check is disabled, or no X marker is left and allow_no_x, all samples are
    kept with the status 'disabled' or 'no_sex_chromosome_markers'; without allow_no_x the latter raises.
    """
    limits = limits or SexLimits(female, male)
    skipped = None if enabled else "disabled"
    x_calls = calls if markers is None else calls.join(markers.filter("chrom = 'X'").select("vid"), "vid", "left_semi")
    if enabled and (x_calls if markers is None else markers.filter("chrom = 'X'")).isEmpty():
        if not allow_no_x:
            raise ValueError("the sex check needs X markers outside the pseudo-autosomal regions")
        skipped = "no_sex_chromosome_markers"
    if skipped:
        none = {"f": F.lit(None).cast("double"), "genetic": F.lit("0"), "y_called": F.lit(None).cast("double"), "status": F.lit(skipped)}
        return SexChecked(manifest.withColumns(none), manifest.select("sid"), manifest.select("sid").limit(0))
    joined = manifest.join(genotype.inbreeding(x_calls).select("sid", "f"), "sid", "left")
    if markers is None:
        joined = joined.withColumn("y_called", F.lit(None).cast("double"))
    else:
        y = calls.join(markers.filter("chrom = 'Y'").select("vid"), "vid", "left_semi").groupBy("sid").agg((F.count("g") / F.count(F.lit(1))).alias("y_called"))
        joined = joined.join(y, "sid", "left")
    f, rate = F.col("f"), F.col("y_called")
    woman, man = f <= limits.female, f >= limits.male
    if limits.female_y is not None:
        woman, man = woman & (rate <= limits.female_y), man & (rate >= limits.male_y)
    joined = joined.withColumn("genetic", F.when(woman, "2").when(man, "1").otherwise("0"))
    detail = joined.withColumn("status", samples.sex_status(F.col("sex"), F.col("ped_sex"), F.col("genetic")))
    problems = detail.filter("status <> 'ok'").select("sid")
    if action == "fail" and (bad := problems.limit(5).collect()):
        raise ValueError(f"sex mismatches: {', '.join(str(r.sid) for r in bad)}")
    remove = problems if action == "exclude" else problems.limit(0)
    return SexChecked(detail, manifest.select("sid").join(remove, "sid", "left_anti"), remove)


def spaced_pool(v: DataFrame, per_chrom: int) -> DataFrame:
    """v (chrom, pos, ...) at the unused positions nearest to per_chrom evenly spaced targets a chromosome.

    Each target's bin passes on only the rows that could be taken (per_chrom from its middle and from either end),
    so the order-bound step holds at most 3 x per_chrom rows a bin.
    """
    ends = v.groupBy("chrom").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / max(per_chrom - 1, 1)
    placed = v.join(F.broadcast(ends), "chrom").withColumn("step", step)  # a row per chromosome
    placed = placed.withColumn("bin", F.when(F.col("step") > 0, F.round((F.col("pos") - F.col("lo")) / F.col("step")).cast("int")).otherwise(0))
    off = F.abs(F.col("pos") - F.col("lo") - F.col("bin") * F.col("step"))
    by = Window.partitionBy("chrom", "bin")
    near = placed.filter("pos is not null").withColumns({"__a": F.row_number().over(by.orderBy("pos")), "__b": F.row_number().over(by.orderBy(F.desc("pos"))), "__c": F.row_number().over(by.orderBy(off, "pos"))})
    near, columns = near.filter(F.least("__a", "__b", "__c") <= per_chrom), v.columns

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["pos", *[c for c in columns if c not in ("chrom", "pos")]], kind="stable")
        pos, free, taken = frame["pos"].to_numpy(float), np.ones(len(frame), bool), []
        for j in range(per_chrom):
            if not free.any():
                break
            at = int(np.argmin(np.where(free, np.abs(pos - frame["lo"].iloc[0] - j * frame["step"].iloc[0]), np.inf)))
            free[at] = False
            taken.append(at)
        return frame.iloc[taken][columns]

    return near.groupBy("chrom").applyInPandas(choose, v.schema)


def spaced_markers(pool: DataFrame, per_chrom: int, min_spacing: int) -> DataFrame:
    """As spaced_pool, of a pool as small as that returns, with chosen positions at least min_spacing apart."""

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos", kind="stable")
        pos, taken = frame["pos"].to_numpy(float), []
        for target in np.linspace(pos[0], pos[-1], per_chrom):
            free = np.array([all(abs(x - pos[t]) >= min_spacing for t in taken) and i not in taken for i, x in enumerate(pos)])
            if not free.any():
                break
            taken.append(int(np.argmin(np.where(free, np.abs(pos - target), np.inf))))
        return frame.iloc[taken]

    return pool.groupBy("chrom").applyInPandas(choose, pool.schema)


class NullModel(NamedTuple):
    rows: DataFrame  # (sid, chrom, eta, r, w, covariates...): linear predictor, residual and weight of each sample
    columns: list[str]


def null_logistic(pheno: DataFrame, covariates: list[str], chroms: DataFrame, loco: DataFrame | None = None, rounds: int = 25) -> NullModel:
    """The logistic model of a 0/1 trait without variants, for each chromosome with its offset (sid, chrom, pred).

    A round of Newton's method is one aggregate by chromosome; matrices as small as the number of
    covariates reach the driver.
    """
    whole = pheno.select("sid", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in covariates]).dropna()
    means = whole.agg(*[F.avg(c) for c in covariates]).first() if covariates else []
    q, names = _orthonormal(whole.select("sid", *[(F.col(c) - float(m or 0)).alias(c) for c, m in zip(covariates, means, strict=True)]), "sid", covariates) if covariates else (whole.select("sid"), [])
    rows = whole.select("sid", "y").join(F.broadcast(chroms.select("chrom").distinct())).join(q, "sid")  # a row per chromosome: some two dozen
    offset = F.lit(0.0)
    if loco is not None:
        rows, offset = rows.join(loco.select("sid", "chrom", "pred"), ["sid", "chrom"], "left"), F.coalesce("pred", F.lit(0.0))
    rows = stored(rows.select("sid", "chrom", "y", F.lit(1.0).alias("one"), *names, offset.alias("offset")))
    columns = ["one", *names]
    k = len(columns)
    weights = {c.chrom: np.zeros(k) for c in chroms.select("chrom").distinct().collect()}

    def fitted() -> DataFrame:
        table = rows.sparkSession.createDataFrame([(c, *map(float, w)) for c, w in weights.items()], "chrom string, " + ", ".join(f"b{i} double" for i in range(k)))
        met = rows.join(F.broadcast(table), "chrom")  # a row per chromosome
        eta = reduce(lambda a, b: a + b, [F.col(f"b{i}") * F.col(c) for i, c in enumerate(columns)], F.col("offset"))
        mu = 1 / (1 + F.exp(-F.col("eta")))
        return met.withColumn("eta", eta).withColumns({"r": F.col("y") - mu, "w": mu * (1 - mu)})

    for _ in range(rounds):
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        sums = fitted().groupBy("chrom").agg(*[F.sum(F.col("w") * F.col(columns[i]) * F.col(columns[j])) for i, j in pairs], *[F.sum(F.col("r") * F.col(c)) for c in columns]).collect()
        moved = 0.0
        for row in sums:
            info, score = np.zeros((k, k)), np.array(row[1 + len(pairs) :], float)
            for v, (i, j) in zip(row[1:], pairs, strict=False):
                info[i, j] = info[j, i] = v
            step = np.clip(np.linalg.pinv(info, rcond=1e-10, hermitian=True) @ score, -5, 5)
            weights[row.chrom] += step
            moved = max(moved, np.abs(step).max(initial=0))
        if moved < 1e-9:
            break
    return NullModel(stored(fitted().select("sid", "chrom", "eta", "r", "w", *columns)), columns)


def pooled_binary(calls: DataFrame, variants: DataFrame, pheno: DataFrame, covariates: list[str], loco: DataFrame | None = None, min_mac: float = 0, min_info: float = 0, firth_p: float = 0.01) -> DataFrame:
    """(vid, n, beta, se, chi2, p, test): score test of a 0/1 trait given covariates and the offset of the variant's chromosome.

    Where the score test's p is below firth_p, the effect is fitted again with Firth's penalty, the null model's
    linear predictor held fixed; a variant's samples are one group there. A missing call counts as the mean;
    min_info cuts the ratio of the dosages' variance to its expectation.
    """
    model = null_logistic(pheno, covariates, variants, loco)
    names, k = model.columns, len(model.columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    g, w = F.col("g").cast("double"), F.col("w")
    met = calls.filter("g is not null").join(variants.select("vid", "chrom"), "vid").join(model.rows, ["sid", "chrom"])
    sums = met.groupBy("vid", "chrom").agg(
        F.count(F.lit(1)).alias("n"), F.avg(g).alias("m"), F.sum(g * g).alias("gg"), F.sum("r").alias("r"), F.sum(g * F.col("r")).alias("gr"), F.sum(w * g * g).alias("wgg"), F.sum(w * g).alias("wg"), F.sum(w).alias("sw"),
        F.array(*[F.sum(w * g * F.col(c)) for c in names]).alias("wgx"), F.array(*[F.sum(w * F.col(c)) for c in names]).alias("wx"),
    )
    whole = model.rows.groupBy("chrom").agg(F.sum("r").alias("all_r"), F.sum("w").alias("all_w"), F.array(*[F.sum(w * F.col(c)) for c in names]).alias("all_wx"), F.array(*[F.sum(w * F.col(names[i]) * F.col(names[j])) for i, j in pairs]).alias("xwx"))

    @F.pandas_udf("array<double>")
    def explained(c: pd.Series, xwx: pd.Series) -> pd.Series:
        """The coefficients of a variant on the covariates, from their weighted products."""
        m = np.empty((len(c), k, k))
        for at, (i, j) in enumerate(pairs):
            m[:, i, j] = m[:, j, i] = [x[at] for x in xwx]
        return pd.Series(list((np.linalg.pinv(m, rcond=1e-10, hermitian=True) @ np.stack(c.to_numpy())[:, :, None])[:, :, 0])) if len(c) else pd.Series([], dtype=object)

    m, n = F.col("m"), F.col("n")
    info = (F.col("gg") / n - m * m) / (m * (1 - m / 2))
    tested = sums.filter((F.least(n * m, n * (2 - m)) >= min_mac) & (F.coalesce(info, F.lit(0.0)) >= min_info)).join(F.broadcast(whole), "chrom")  # a row per chromosome
    # missing calls at the mean: their rows are the whole model's less the called ones
    full = [F.col("wgx")[i] + m * (F.col("all_wx")[i] - F.col("wx")[i]) for i in range(k)]
    tested = tested.withColumns({"u": F.col("gr") + m * (F.col("all_r") - F.col("r")), "c": F.array(*full)})
    tested = tested.withColumn("a", explained("c", "xwx"))
    spread = F.col("wgg") + m * m * (F.col("all_w") - F.col("sw")) - reduce(lambda a, b: a + b, [F.col("a")[i] * F.col("c")[i] for i in range(k)])
    scored = tested.withColumn("v", spread).filter("v > 1e-9")
    scored = stored(scored.select("vid", "chrom", "n", "m", "a", (F.col("u") / F.col("v")).alias("beta"), (1 / F.sqrt("v")).alias("se"), (F.col("u") ** 2 / F.col("v")).alias("chi2")).withColumn("p", chi2_tail("chi2")))
    strong = scored.filter(F.col("p") < firth_p)
    fixed = reduce(lambda x, y: x + y, [F.col("a")[i] * F.col(c) for i, c in enumerate(names)])
    rows = calls.filter("g is not null").join(strong.select("vid", "chrom", "a"), "vid").join(model.rows, ["sid", "chrom"]).select("vid", "eta", (F.col("r") + 1 / (1 + F.exp(-F.col("eta")))).alias("y"), (g - fixed).alias("x"))

    def firth(frame: pd.DataFrame) -> pd.DataFrame:
        x, y, eta, b = frame["x"].to_numpy(), np.round(frame["y"].to_numpy()), frame["eta"].to_numpy(), 0.0

        def parts(b: float) -> tuple[float, float, float]:
            z = eta + b * x
            mu = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            v = mu * (1 - mu)
            info = float(v @ (x * x))
            hat = v * x * x / max(info, 1e-300)
            return float(y @ z - np.logaddexp(0, z).sum() + 0.5 * np.log(max(info, 1e-300))), float(x @ (y - mu + hat * (0.5 - mu))), info

        for _ in range(50):
            level, score, info = parts(b)
            step = float(np.clip(score / max(info, 1e-300), -2, 2))
            while abs(step) > 1e-12 and parts(b + step)[0] < level - 1e-12:
                step /= 2
            b += step
            if abs(step) < 1e-9:
                break
        chi2 = max(0.0, 2 * (parts(b)[0] - parts(0.0)[0]))
        return pd.DataFrame({"vid": [frame["vid"].iloc[0]], "fb": [b], "fchi2": [chi2]})

    again = rows.groupBy("vid").applyInPandas(firth, "vid long, fb double, fchi2 double").withColumn("fp", chi2_tail("fchi2"))
    met = scored.join(again, "vid", "left")
    better = F.col("fb").isNotNull()
    return met.select(
        "vid", "n", F.coalesce("fb", "beta").alias("beta"), F.when(better & (F.col("fchi2") > 0), F.abs("fb") / F.sqrt("fchi2")).otherwise(F.col("se")).alias("se"),
        F.coalesce("fchi2", "chi2").alias("chi2"), F.coalesce("fp", "p").alias("p"), F.when(better, "firth").otherwise("score").alias("test"),
    )


def pooled_pass_list(union: DataFrame, calls: DataFrame, max_missing: float = 0.05, maf: float = 0.01) -> DataFrame:
    """(vid): variants of the union (vid) that the pooled samples' missingness and frequency pass, too."""
    kept = genotype.allele_counts(calls).filter((F.col("maf") >= maf) & (F.col("missing") / (F.col("n") + F.col("missing")) <= max_missing))
    return union.select("vid").distinct().join(kept.select("vid"), "vid", "left_semi")
