"""Sample identities, traits and covariates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators import quality

MISSING = ("", "NA", "-9", ".")


def _aliases(df: DataFrame, *keep: str) -> DataFrame:
    """One row per spelling of a sample, by priority: family id, individual id, '0'."""
    spelled = F.array_distinct(F.array(F.col("fid"), F.col("iid"), F.lit("0")))
    return df.select(*keep, "fid", "iid", F.posexplode(spelled).alias("priority", "alias"))


def ambiguous_aliases(target: DataFrame) -> DataFrame:
    """Spellings that two target rows own."""
    return _aliases(target).groupBy("alias", "iid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def match_samples(query: DataFrame, target: DataFrame) -> DataFrame:
    """query rows with target_fid and target_iid: the target that owns the row's first matching spelling; else NULL.

    A spelling that two target rows own is an error, whether or not a query row has it.
    """
    quality.require(ambiguous_aliases(target), "spellings that several samples own")
    q = query.withColumn("__q", F.struct("fid", "iid"))
    owners = _aliases(target).select(F.col("alias"), F.col("iid").alias("t_iid"), F.struct("fid", "iid").alias("t"))
    hits = _aliases(q.select("fid", "iid", "__q").distinct(), "__q").withColumn("t_iid", F.col("iid")).join(owners, ["alias", "t_iid"])
    best = hits.groupBy("__q").agg(F.min_by("t", "priority").alias("t"))
    return q.join(best, "__q", "left").select(*query.columns, F.col("t.fid").alias("target_fid"), F.col("t.iid").alias("target_iid"))


def canonicalize_ids(ids: DataFrame, target: DataFrame) -> DataFrame:
    """ids as target spells them; ids that target lacks are an error."""
    matched = match_samples(ids, target)
    quality.require(matched.filter("target_iid is null").select("fid", "iid"), "samples that the target lacks")
    return matched.select(*[c for c in ids.columns if c not in ("fid", "iid")], F.col("target_fid").alias("fid"), F.col("target_iid").alias("iid"))


def attach_metadata(samples: DataFrame, meta: DataFrame, order: list[str]) -> DataFrame:
    """samples with the columns of meta (fid, iid, ...); of meta's rows of one sample the first in order counts, samples without one are an error."""
    columns = [c for c in meta.columns if c not in ("fid", "iid")]
    first = meta.groupBy("fid", "iid").agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("m"))
    matched = match_samples(samples, first.select("fid", "iid"))
    quality.require(matched.filter("target_iid is null").select("fid", "iid"), "samples without metadata")
    named = first.select(F.col("fid").alias("target_fid"), F.col("iid").alias("target_iid"), "m")
    return matched.join(named, ["target_fid", "target_iid"]).select(*samples.columns, "m.*")


def in_both(reference: DataFrame, study: DataFrame) -> DataFrame:
    """(fid, iid) of the study's samples that the reference has, too, under any spelling."""
    return match_samples(study.select("fid", "iid"), reference.select("fid", "iid")).filter("target_iid is not null").select("fid", "iid")


def merge_cohorts(reference: DataFrame, study: DataFrame, labels: DataFrame) -> DataFrame:
    """(fid, iid, sample_set, label) of both: reference rows with their label (fid, iid, label), study rows with '-'; a sample in both is an error."""
    quality.require(in_both(reference, study), "samples in reference and study")
    named = reference.select("fid", "iid").join(labels.select("fid", "iid", "label"), ["fid", "iid"], "left")
    return named.select("fid", "iid", F.lit("reference").alias("sample_set"), "label").unionByName(study.select("fid", "iid", F.lit("study").alias("sample_set"), F.lit("-").alias("label")))


def intersect_keeps(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Samples of every list, spelled as in the first."""
    return reduce(lambda a, b: match_samples(a, b).filter("target_iid is not null").select("fid", "iid"), others, first.select("fid", "iid"))


def missing_from(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys), keys, "left_anti")


def attach_covariates(samples: DataFrame, pcs: DataFrame, columns: list[str]) -> DataFrame:
    """samples with columns, from samples where it has them and else from pcs by any spelling of the id."""
    own = [c for c in columns if c in samples.columns]
    other = [c for c in columns if c not in own]
    matched = match_samples(samples, pcs).join(pcs.select(F.col("fid").alias("target_fid"), F.col("iid").alias("target_iid"), *other), ["target_fid", "target_iid"], "left")
    return matched.select(*samples.columns, *other)


def attach_ancestry(samples: DataFrame, assigned: DataFrame, excluded: DataFrame) -> DataFrame:
    """samples with ancestry (default UNKNOWN) and reason."""
    keys = ["fid", "iid"]
    joined = samples.join(assigned.select(*keys, F.col("ancestry").alias("a")), keys, "left").join(excluded.select(*keys, F.col("reason").alias("r")), keys, "left")
    reason = F.when(F.col("a").isNotNull(), "assigned").otherwise(F.coalesce("r", F.lit("missing_popmad_assignment")))
    return joined.select(*samples.columns, F.coalesce("a", F.lit("UNKNOWN")).alias("ancestry"), reason.alias("reason"))


def encode_trait(c: str, case: str, control: str, coding: tuple[int, int] = (2, 1), missing: tuple[str, ...] = MISSING) -> tuple[Column, Column]:
    """(code, whether the text is none of case, control and missing)."""
    x = F.col(c)
    code = F.when(x == case, F.lit(coding[0])).when(x == control, F.lit(coding[1]))
    return code, x.isNotNull() & ~x.isin(case, control, *missing)


def quantitative(c: str, missing: tuple[str, ...] = MISSING) -> Column:
    return E.finite(E.nullify(c, missing))


def trait_type(samples: DataFrame, trait: str, case: str = "", control: str = "") -> str:
    """'bt' if both codes are set, 'qt' if neither is and every value present is a finite number."""
    if bool(case) != bool(control):
        raise ValueError(f"{trait}: one of case and control is blank")
    if case:
        return "bt"
    bad = samples.select(F.count_if(E.nullify(trait, MISSING).isNotNull() & quantitative(trait).isNull())).first()[0]
    if bad:
        raise ValueError(f"{trait}: {bad} values are not numbers")
    return "qt"


def complete_cases(df: DataFrame, covariates: list[str], y: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [E.finite(c).isNotNull() for c in covariates], F.col(y).isNotNull()))


def model_gate(summary: DataFrame, min_n: int = 300, min_cases: int = 50, min_controls: int = 50) -> DataFrame:
    """summary (n, cases, controls) with skipped and the composed reason; case limits only where cases is set."""
    parts = [
        F.when(F.col(c) < low, F.format_string(f"{c}=%d<min_{c}={low}", c)) for c, low in (("n", min_n), ("cases", min_cases), ("controls", min_controls))
    ]
    reason = F.concat_ws(";", *parts)
    return summary.withColumn("reason", reason).withColumn("skipped", reason != "")


def sex_status(manifest: Column, pedigree: Column, genetic: Column) -> Column:
    """ok, or the mismatches of the stated codes with the genetic one; a missing code can't mismatch the manifest's."""
    known = ~manifest.isin("0", *MISSING) & ~genetic.isin("0", *MISSING)
    return F.coalesce(F.nullif(F.concat_ws(";", F.when(pedigree != genetic, "plink_pedsex_genetic_mismatch"), F.when(known & (manifest != genetic), "manifest_genetic_mismatch")), F.lit("")), F.lit("ok"))
