"""Ancestry assignment from principal components, strata, and ancestry proportions."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.functions import expr as E
from helixframe.operators import quality
from helixframe.plans.stored import written

RIDGE = 1e-4


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _inverse(flat: pd.Series) -> pd.Series:
    """The inverse of each square matrix, by rows."""
    return pd.Series([np.linalg.inv(np.asarray(m, float).reshape(int(len(m) ** 0.5), -1)).ravel() for m in flat], flat.index)


def population_models(ref: DataFrame, pcs: list[str], ridge: float = RIDGE) -> DataFrame:
    """(population, super_population, n, mu, inverse): means of any number of components, and the inverse covariance by rows.

    The covariance (n - 1) gets ridge on its diagonal; populations of one have the identity. All sums
    come from one aggregate; only the matrices, one a population, go to NumPy.
    """
    k = len(pcs)
    pairs = {(i, j): F.coalesce(F.covar_samp(pcs[i], pcs[j]), F.lit(0.0)) for i in range(k) for j in range(i, k)}
    cells = [pairs[min(i, j), max(i, j)] + (ridge if i == j else 0.0) for i in range(k) for j in range(k)]
    one = [F.lit(float(i == j)) for i in range(k) for j in range(k)]
    s = ref.groupBy("population", "super_population").agg(F.count(F.lit(1)).alias("n"), F.array(*map(F.avg, pcs)).alias("mu"), F.array(*cells).alias("c"))
    return s.select("population", "super_population", "n", "mu", _inverse(F.when(F.col("n") > 1, F.col("c")).otherwise(F.array(*one))).alias("inverse"))


def population_distances(study: DataFrame, models: DataFrame, pcs: list[str]) -> DataFrame:
    """(sid, population, super_population, distance) to every model; models are one small row per population."""
    k = len(pcs)
    packed = models.agg(F.collect_list(F.struct("population", "super_population", "mu", "inverse")).alias("models"))
    met = study.select("sid", *pcs).join(F.broadcast(packed)).select("sid", *pcs, F.inline("models"))  # one row holds all models
    met = met.select("sid", "population", "super_population", "inverse", *[(F.col(c) - F.col("mu")[i]).alias(f"__d{i}") for i, c in enumerate(pcs)])
    terms = [F.col("inverse")[i * k + j] * F.col(f"__d{i}") * F.col(f"__d{j}") * (1.0 if i == j else 2.0) for i in range(k) for j in range(i, k)]
    return met.select("sid", "population", "super_population", F.sqrt(F.greatest(reduce(lambda a, b: a + b, terms), F.lit(0.0))).alias("distance"))


def validate_pcs(df: DataFrame, pcs: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, excluded rows with reason missing_or_nonfinite_<first bad component>)."""
    bad = [F.when(~F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False)) | F.isnan(F.col(c).cast("double")), F.lit(f"missing_or_nonfinite_{c}")) for c in pcs]
    judged = df.withColumn("reason", F.coalesce(*bad))
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def robust_cutoff(df: DataFrame, value: str, by: str, multiplier: float = 4.0) -> DataFrame:
    """(by, cutoff): median plus multiplier times the deviation around the median (n - 1)."""
    middle = df.groupBy(by).agg(F.median(value).alias("mid"))
    return df.join(middle, by).groupBy(by).agg((F.first("mid") + multiplier * F.sqrt(F.sum((F.col(value) - F.col("mid")) ** 2) / F.greatest(F.count(F.lit(1)) - 1, F.lit(1)))).alias("cutoff"))


def rank_populations(distances: DataFrame) -> DataFrame:
    return distances.selectExpr("*", "row_number() over (partition by sid order by distance, population) as rank")


def ancestry_confidence(distances: DataFrame) -> DataFrame:
    """(sid, confidence): one minus nearest over second nearest super-population distance, within [0, 1]."""
    least = distances.groupBy("sid", "super_population").agg(F.min("distance").alias("d"))
    two = least.groupBy("sid").agg(F.slice(F.array_sort(F.collect_list("d")), 1, 2).alias("d"))
    d1, d2 = F.get("d", F.lit(0)), F.get("d", F.lit(1))
    return two.select("sid", F.when(d2.isNull() | (d2 == 0), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - d1 / d2))).alias("confidence"))


class Assignment(NamedTuple):
    """What an assignment writes; all tables follow from one stored table of distances."""

    judged: DataFrame  # (sid, population, super_population, distance, cutoff, confidence, ancestry, reason)
    distances: DataFrame  # (sid, population, super_population, distance) to every model
    outliers: DataFrame  # (sid, population, super_population, distance, cutoff) of the reference samples that were dropped
    models: DataFrame  # (population, super_population, n_input, n_retained, n_outliers, reference_outlier_cutoff, assignment_cutoff, pc_count, model_status)
    assigned: DataFrame  # (sid, ancestry, population, distance, confidence)
    within: DataFrame  # (sid, ancestry, components...) of the assigned
    excluded: DataFrame  # (sid, best_ancestry, best_population, best_distance, confidence, reason)
    counts: DataFrame  # (category, population, ancestry, n)


def assignment(study: DataFrame, ref: DataFrame, pcs: list[str], labels: list, multiplier: float = 4.0, min_confidence: float = 0.05, min_n: int = 20) -> Assignment:
    """Samples of study by the nearest population model of ref (sid, population, super_population, components...).

    Models are fitted, reference outliers of populations over ten dropped, and models refitted; populations of
    fewer than min_n have none. A label without a model is an error.
    """
    def own(reference: DataFrame, models: DataFrame) -> DataFrame:
        mine = reference.select("sid", *pcs, F.col("population").alias("own"))
        return population_distances(mine, models, pcs).join(mine.select("sid", "own"), "sid").filter("population = own")

    first = written(population_models(ref, pcs), "models")
    near = written(own(ref, first), "near")
    limit = written(robust_cutoff(near, "distance", "population", multiplier), "limit")
    sized = near.join(F.broadcast(limit), "population").join(F.broadcast(first.select("population", "n")), "population")  # rows per population
    far = (F.col("distance") > F.col("cutoff")) & (F.col("n") > 10)
    outliers = written(sized.filter(far).select("sid", "population", "super_population", "distance", "cutoff"), "outliers")
    kept = ref.join(outliers.select("sid"), "sid", "left_anti")
    fitted = written(population_models(kept, pcs), "models")
    models = fitted.filter(F.col("n") >= min_n)
    cutoffs = written(robust_cutoff(own(kept, models), "distance", "population", multiplier), "cutoffs")
    without = ref.sparkSession.createDataFrame([(x,) for x in labels], ["super_population"]).join(models, "super_population", "left_anti")
    quality.require(without, "super-populations without a model")
    distances = written(population_distances(study, models, pcs), "distances")
    best = rank_populations(distances).filter("rank = 1").drop("rank")
    joined = best.join(F.broadcast(cutoffs), "population", "left").join(ancestry_confidence(distances), "sid")  # a row per population
    reason = (
        F.when(~F.col("super_population").isin(*labels), "unconfigured_nearest_super_population").when(F.col("distance") > F.col("cutoff"), "outside_reference_population_distance")
        .when(F.col("confidence") < min_confidence, "ambiguous_nearest_ancestries")
    )
    judged = written(joined.withColumn("reason", reason).withColumn("ancestry", F.when(F.col("reason").isNull(), F.col("super_population"))), "judged")
    assigned = judged.filter("reason is null").select("sid", "ancestry", "population", "distance", "confidence")
    excluded = judged.filter("reason is not null").select("sid", F.col("super_population").alias("best_ancestry"), F.col("population").alias("best_population"), F.col("distance").alias("best_distance"), "confidence", "reason")
    dropped = outliers.groupBy("population").agg(F.count(F.lit(1)).alias("n_outliers"))
    summary = first.select("population", "super_population", F.col("n").alias("n_input")).join(fitted.select("population", F.col("n").alias("n_retained")), "population", "left").join(dropped, "population", "left")
    summary = summary.join(limit.withColumnRenamed("cutoff", "reference_outlier_cutoff"), "population", "left").join(cutoffs.withColumnRenamed("cutoff", "assignment_cutoff"), "population", "left").fillna(0, ["n_retained", "n_outliers"])
    summary = summary.withColumns({"pc_count": F.lit(len(pcs)), "model_status": F.when(F.col("n_retained") >= min_n, "retained").otherwise("dropped_low_reference_n")})
    n, every = F.count(F.lit(1)).alias("n"), F.lit("ALL")
    counts = [
        assigned.groupBy("population", F.col("ancestry").cast("string").alias("ancestry")).agg(n).select(F.lit("assigned_population").alias("category"), F.col("population").cast("string").alias("population"), "ancestry", "n"),
        assigned.groupBy(F.col("ancestry").cast("string").alias("ancestry")).agg(n).select(F.lit("assigned_ancestry").alias("category"), every.alias("population"), "ancestry", "n"),
        excluded.groupBy("reason").agg(n).select(F.lit("excluded_reason").alias("category"), every.alias("population"), F.col("reason").alias("ancestry"), "n"),
        excluded.agg(n).select(F.lit("excluded_total").alias("category"), every.alias("population"), every.alias("ancestry"), "n"),
    ]
    columns = ["population", "super_population", "n_input", "n_retained", "n_outliers", "reference_outlier_cutoff", "assignment_cutoff", "pc_count", "model_status"]
    return Assignment(judged, distances, outliers, summary.select(*columns), assigned, study.select("sid", *pcs).join(assigned.select("sid", "ancestry"), "sid").select("sid", "ancestry", *pcs), excluded, reduce(DataFrame.unionByName, counts))


def assign_ancestry(study: DataFrame, ref: DataFrame, pcs: list[str], labels: list, multiplier: float = 4.0, min_confidence: float = 0.05, min_n: int = 20) -> DataFrame:
    """(sid, population, super_population, distance, cutoff, confidence, ancestry, reason) of assignment."""
    return assignment(study, ref, pcs, labels, multiplier, min_confidence, min_n).judged


def reference_coverage(meta: DataFrame, min_n: int = 20) -> DataFrame:
    """(population, super_population, n, retained, orphaned): whether a population gets a model, and whether none of its super-population's does."""
    per = meta.groupBy("population", "super_population").agg(F.count(F.lit(1)).alias("n")).withColumn("retained", F.col("n") >= min_n)
    any_left = per.groupBy("super_population").agg(F.bool_or("retained").alias("any"))
    return per.join(any_left, "super_population").select("population", "super_population", "n", "retained", (~F.col("any")).alias("orphaned"))


def assignment_rollup(assigned: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """(kind, ancestry, population, n): assigned samples with subtotals by ancestry and the total, as ALL; excluded ones by reason."""
    rolled = assigned.groupingSets([["ancestry", "population"], ["ancestry"], []], "ancestry", "population").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))
    label = lambda c, level: F.when(F.col("level") >= level, "ALL").otherwise(F.col(c).cast("string")).alias(c)
    out = rolled.select(F.lit("assigned").alias("kind"), label("ancestry", 2), label("population", 1), "n")
    if excluded is None:
        return out
    reasons = excluded.rollup("reason").agg(F.count(F.lit(1)).alias("n"), F.grouping("reason").alias("level"))
    return out.unionByName(reasons.select(F.lit("excluded").alias("kind"), label("reason", 1).alias("ancestry"), F.lit("ALL").alias("population"), "n"))


def active_strata(assigned: DataFrame, labels: DataFrame, min_n: int = 50) -> DataFrame:
    per = assigned.groupBy("ancestry").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    reason = F.when(n == 0, "no_assigned_samples").when(n < min_n, "below_min_stratum_n").otherwise("")
    return labels.join(per, "ancestry", "left").select("ancestry", n.alias("n"), (reason == "").alias("active"), reason.alias("reason"))


def strata_counts(samples: DataFrame, code: Column) -> DataFrame:
    """(ancestry, n, cases, controls) of samples (ancestry, ...) with a 2/1 trait code, and an ALL row."""
    rolled = samples.withColumn("code", code).rollup("ancestry").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("code") == 2).alias("cases"), F.count_if(F.col("code") == 1).alias("controls"), F.grouping("ancestry").alias("total"))
    return rolled.select(F.when(F.col("total") == 1, "ALL").otherwise(F.col("ancestry").cast("string")).alias("ancestry"), "n", "cases", "controls")


def trait_strata(samples: DataFrame, codes: dict[str, Column], values: dict[str, Column], strata: DataFrame, min_n: int = 300, min_cases: int = 100, min_controls: int = 100) -> DataFrame:
    """(trait, ancestry, n, cases, controls, active, excluded_reason, underpowered) of each trait in each stratum, and of all samples in no active stratum.

    codes are 2/1 codes of binary traits, values the numbers of quantitative ones; strata is active_strata().
    """
    sides = [F.struct(F.lit(t).alias("trait"), F.lit(True).alias("binary"), c.cast("double").alias("v")) for t, c in codes.items()] + [F.struct(F.lit(t).alias("trait"), F.lit(False).alias("binary"), c.cast("double").alias("v")) for t, c in values.items()]
    per = samples.select("ancestry", F.inline(F.array(*sides))).groupBy("trait", "binary", "ancestry").agg(F.count("v").alias("n"), F.count_if(F.col("v") == 2).alias("c2"), F.count_if(F.col("v") == 1).alias("c1"))
    traits = samples.sparkSession.createDataFrame([(t, True) for t in codes] + [(t, False) for t in values], "trait string, binary boolean")
    every = strata.select("ancestry", "active", F.col("reason").alias("excluded_reason")).join(F.broadcast(traits))  # a row per stratum and trait
    met = every.join(per, ["trait", "binary", "ancestry"], "left").withColumns({"n": F.coalesce("n", F.lit(0)), "cases": F.when(F.col("binary"), F.coalesce("c2", F.lit(0))), "controls": F.when(F.col("binary"), F.coalesce("c1", F.lit(0)))})
    weak = (F.col("n") < min_n) | F.coalesce(F.col("cases") < min_cases, F.lit(False)) | F.coalesce(F.col("controls") < min_controls, F.lit(False))
    names = ["trait", "ancestry", "n", "cases", "controls", "active", "excluded_reason", "underpowered"]
    rest = samples.join(F.broadcast(strata.filter("active").select("ancestry")), "ancestry", "left_anti").agg(F.count(F.lit(1)).alias("n"))  # a row per stratum
    total = rest.select(F.lit("ALL").alias("trait"), F.lit("UNASSIGNED").alias("ancestry"), "n", F.lit(None).cast("long").alias("cases"), F.lit(None).cast("long").alias("controls"), F.lit(False).alias("active"), F.lit("not_in_active_strata").alias("excluded_reason"), (F.col("n") > 0).alias("underpowered"))
    return met.withColumn("underpowered", weak).select(*names).unionByName(total)


def empty_cells(counts: DataFrame) -> DataFrame:
    """Active strata of a binary trait (as trait_strata gives them) without a case or without a control."""
    return counts.filter("active and (cases = 0 or controls = 0)").select("trait", "ancestry", "cases", "controls")


def unassigned(samples: DataFrame, max_fraction: float = 1.0, pooled: bool = False) -> DataFrame:
    """(total, unassigned, fraction, status): error beyond max_fraction, or warn where a pooled analysis takes the samples anyway."""
    counted = samples.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("reason").isNotNull()).alias("unassigned")).withColumn("fraction", F.col("unassigned") / F.col("total"))
    return counted.withColumn("status", F.when(F.col("fraction") > max_fraction, "warn" if pooled else "error").otherwise("ok"))


def unassigned_list(samples: DataFrame) -> DataFrame:
    return samples.filter("reason is not null").select("sid", "reason")


def top_component(q: DataFrame) -> DataFrame:
    """(sid, label, q) of the largest proportion, ties by label."""
    best = q.groupBy("sid").agg(F.min_by(F.struct("label", "q"), F.struct((-F.col("q")).alias("m"), "label")).alias("b"))
    return best.select("sid", "b.label", "b.q")


def label_components(q: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, component): the component with each label's largest mean over its reference samples; see ambiguous_components."""
    means = q.join(labels, "sid").groupBy("label", "component").agg(F.avg("q").alias("m"))
    return means.groupBy("label").agg(F.min_by("component", F.struct((-F.col("m")).alias("m"), "component")).alias("component"))


def ambiguous_components(mapping: DataFrame, q: DataFrame) -> DataFrame:
    """(component, labels): components that several labels have, or none; the mapping is one to one if there are no rows."""
    per = mapping.groupBy("component").agg(F.count(F.lit(1)).alias("labels"))
    return q.select("component").distinct().join(per, "component", "left").select("component", F.coalesce("labels", F.lit(0)).alias("labels")).filter("labels <> 1")


def compare_assignments(study: DataFrame, assigned: DataFrame | None) -> DataFrame:
    """study (sid, top) with the status of top against the assigned ancestry (sid, ancestry)."""
    if assigned is None:
        return study.withColumn("status", F.lit("popmad_not_available"))
    met = study.join(assigned.select("sid", F.col("ancestry").cast("string").alias("ancestry"), F.lit(True).alias("__m")), "sid", "left")
    status = F.when(F.col("__m").isNull(), "missing_popmad").when(F.col("top").eqNullSafe(F.col("ancestry")), "match").otherwise("discordant")
    return met.withColumn("status", status).drop("__m", "ancestry")


def proportion_summary(q: DataFrame, compared: DataFrame) -> DataFrame:
    """(metric, value): mean proportion and top count of each label, and how top components agree with assignments; q is (sid, label, q)."""
    per = q.groupBy("label").agg(F.avg("q").alias("m")).select(F.concat(F.lit("mean_proportion_"), F.col("label").cast("string")).alias("metric"), E.fmt_decimal("m").alias("value"))
    tops = q.select("label").distinct().join(top_component(q).groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label", "left")
    tops = tops.select(F.concat(F.lit("top_"), F.col("label").cast("string")).alias("metric"), F.coalesce("n", F.lit(0)).cast("string").alias("value"))
    match, other = F.count_if(F.col("status") == "match"), F.count_if(F.col("status") == "discordant")
    wide = compared.agg(match.alias("m"), other.alias("d"), F.count_if(F.col("status") == "missing_popmad").alias("x"), F.count(F.lit(1)).alias("n"))
    wide = wide.select(F.col("n").cast("string").alias("samples"), F.col("m").cast("string").alias("matches"), F.col("d").cast("string").alias("discordant"), F.col("x").cast("string").alias("missing"), E.fmt_decimal(F.when(F.col("m") + F.col("d") > 0, F.col("m") / (F.col("m") + F.col("d")))).alias("match_rate"))
    return wide.unpivot([], wide.columns, "metric", "value").unionByName(per).unionByName(tops)


def check_projection(fitted: DataFrame, projected: DataFrame, min_r: float = 0.95) -> DataFrame:
    """(pc, n, r, passed) of long tables (sid, pc, score)."""
    met = fitted.join(projected.withColumnRenamed("score", "other"), ["sid", "pc"])
    return met.groupBy("pc").agg(F.count(F.lit(1)).alias("n"), F.corr("score", "other").alias("r")).withColumn("passed", (F.col("n") >= 3) & (F.abs("r") >= min_r))
