"""Summary and report tables: (metric, value) or (section, key, value) rows, all text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators import assoc, quality


def _metrics(wide: DataFrame) -> DataFrame:
    """(metric, value) of one row."""
    text = wide.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in wide.columns])
    return text.unpivot([], text.columns, "metric", "value")


def _section(rows: DataFrame, name: str) -> DataFrame:
    """(section, key, value) of the first two columns of rows."""
    key, value = rows.columns[:2]
    return rows.select(F.lit(name).alias("section"), F.col(key).cast("string").alias("key"), F.coalesce(F.col(value).cast("string"), F.lit("NA")).alias("value"))


def _given(like: DataFrame, settings: dict[str, str]) -> DataFrame:
    return like.sparkSession.createDataFrame([("settings", k, v) for k, v in settings.items()], "section string, key string, value string")


def trait_model_summary(samples: DataFrame, trait: str, binary: bool, covariates: list[str], code: Column, min_n: int = 300, min_cases: int = 50, min_controls: int = 50) -> DataFrame:
    """One row (trait, kind, pan_n, complete_n, usable_n, cases, controls, model_n, keep_hash, skipped, reason) of a pooled model.

    code is the trait's number, 2 and 1 for cases and controls; samples has sid. keep_hash says which samples are kept, whatever their order.
    """
    whole = reduce(lambda a, b: a & b, [E.finite(c).isNotNull() for c in covariates], F.lit(True))
    used = whole & F.col("__v").isNotNull()
    s = samples.withColumn("__v", code)
    count = s.agg(
        F.count(F.lit(1)).alias("pan_n"), F.count_if(whole).alias("complete_n"), F.count_if(used).alias("usable_n"), (F.count_if(used & (F.col("__v") == 2)) if binary else F.lit(None).cast("long")).alias("cases"),
        (F.count_if(used & (F.col("__v") == 1)) if binary else F.lit(None).cast("long")).alias("controls"), F.bit_xor(F.when(used, F.xxhash64("sid"))).alias("keep_hash"),
    )
    limits = (("usable_n", "n", min_n), ("cases", "cases", min_cases), ("controls", "controls", min_controls))
    reason = F.concat_ws(";", *[F.when(F.col(c) < low, F.format_string(f"{n}=%d<min_{n}={low}", c)) for c, n, low in limits])
    judged = count.withColumn("reason", reason).withColumn("skipped", reason != "")
    return judged.select(
        F.lit(trait).alias("trait"), F.lit("bt" if binary else "qt").alias("kind"), "pan_n", "complete_n", "usable_n", "cases", "controls",
        F.when(F.col("skipped"), 0).otherwise(F.col("usable_n")).alias("model_n"), F.when(~F.col("skipped"), F.col("keep_hash")).alias("keep_hash"), "skipped", "reason",
    )


def consolidate_status(*summaries: DataFrame) -> DataFrame:
    """All traits' summary rows with their group; a trait that repeats is an error."""
    rows = reduce(DataFrame.unionByName, summaries).withColumn("group_id", E.group_id("kind", "trait"))
    quality.require(quality.duplicates(rows, "trait"), "traits that repeat")
    return rows.withColumn("eligible", ~F.col("skipped"))


def pan_summary(manifest: DataFrame, checked: DataFrame, pan: DataFrame) -> DataFrame:
    """(metric, value): samples of the manifest, past the sex check and in the pooled analysis, and how many of these have an ancestry (pan has sid, ancestry)."""
    a = manifest.agg(F.count(F.lit(1)).alias("manifest_samples"))
    b = checked.agg(F.count(F.lit(1)).alias("sex_checked_samples"))
    known = F.coalesce(F.col("ancestry").cast("string"), F.lit("UNKNOWN")) != "UNKNOWN"
    c = pan.agg(F.count(F.lit(1)).alias("pan_samples"), F.count_if(known).alias("assigned"), F.count_if(~known).alias("unknown"))
    return _metrics(a.join(F.broadcast(b)).join(F.broadcast(c)))  # one row each


def sex_check_summary(detail: DataFrame, action: str = "warn", markers: DataFrame | None = None) -> DataFrame:
    """(metric, value) of a sex check's detail (sid, status, genetic), with the number of its markers (vid, chrom)."""
    bad = F.col("status") != "ok"
    wide = detail.agg(F.count(F.lit(1)).alias("checked"), F.count_if(bad).alias("problems"), F.count_if(F.lit(action != "exclude") | ~bad).alias("kept"), F.count_if(F.lit(action == "exclude") & bad).alias("removed"))
    out = _metrics(wide.withColumn("action", F.lit(action)))
    if markers is None:
        return out
    return out.unionByName(_metrics(markers.agg(F.count_if(F.col("chrom") == "X").alias("x_markers"), F.count_if(F.col("chrom") == "Y").alias("y_markers"))))


def ld_coverage(index: DataFrame, v: DataFrame, genes: DataFrame) -> DataFrame:
    """(metric, value) of an LD index (gene, id) over target variants (id, chrom, pos) and genes (gene, chrom, start, end)."""
    joined = index.join(v.select("id", "chrom", "pos"), "id").join(genes.select("gene", F.col("chrom").alias("gc"), "start", "end"), "gene")
    inside = (F.col("chrom") == F.col("gc")) & F.col("pos").between(F.col("start"), F.col("end"))
    a = joined.agg(F.count(F.lit(1)).alias("assignments"), F.count_if(inside).alias("within"))
    n = v.select("id").distinct().join(index.select("id", F.lit(1).alias("hit")).distinct(), "id", "left").agg(F.count(F.lit(1)).alias("targets"), F.count("hit").alias("indexed"))
    g = genes.select("gene").distinct().join(index.select("gene", F.lit(1).alias("hit")).distinct(), "gene", "left").agg(F.count(F.lit(1)).alias("genes"), F.count("hit").alias("indexed_genes"))
    one = a.join(F.broadcast(n)).join(F.broadcast(g))  # one row each
    return _metrics(one.select(
        "targets", "indexed", (F.col("targets") - F.col("indexed")).alias("not_indexed"), E.fmt_percent("indexed", "targets").alias("target_coverage_pct"), "genes", "indexed_genes", (F.col("genes") - F.col("indexed_genes")).alias("genes_without_variants"),
        E.fmt_percent("indexed_genes", "genes").alias("gene_coverage_pct"), "assignments", "within", (F.col("assignments") - F.col("within")).alias("outside"), E.fmt_percent("within", "assignments").alias("within_pct"),
    ))


def bind_strata(parts: dict[str, DataFrame], columns: list[str], tag: str = "stratum") -> DataFrame:
    """The columns of several strata's tables under one another, with the stratum; a table that lacks one is an error."""
    for d in parts.values():
        quality.expect_columns(d, *columns)
    return reduce(DataFrame.unionByName, [d.select(F.lit(label).alias(tag), *columns) for label, d in parts.items()])


def pooled_report(stats: DataFrame, settings: dict[str, str], by_ancestry: DataFrame | None = None) -> DataFrame:
    """Settings, metrics, the strongest signals, and inflation overall and by ancestry ((ancestry, p, ...), a handful of them)."""
    metrics = assoc.assoc_metrics(stats).select("metric", F.format_string("%.6g", "value").alias("value"))
    top = assoc.top_hits(stats).select("id", F.format_string("%.3e", "p").alias("p"))
    out = _given(stats, settings).unionByName(_section(metrics, "metrics")).unionByName(_section(top, "top_signals"))
    tables = {"pooled": stats}
    if by_ancestry is not None:
        labels = sorted(str(r[0]) for r in by_ancestry.select("ancestry").distinct().collect() if r[0] is not None)
        tables |= {a: by_ancestry.filter(F.col("ancestry").cast("string") == a) for a in labels}
    for label, table in tables.items():
        inflation = assoc.genomic_lambda(table).select(F.lit(label).alias("label"), E.fmt_decimal("lambda").alias("value"))
        out = out.unionByName(_section(inflation, "lambda"))
    return out


def rare_report(stats: DataFrame, settings: dict[str, str], binary: bool = True) -> DataFrame:
    """Settings, bins of allele counts, and cross-checks of a rare-variant table (id, p, mac, ...)."""
    checks = rare_checks(stats).select("check", F.concat_ws("|", F.col("left").cast("string"), F.col("right").cast("string"), F.when(F.col("ok"), "ok").otherwise("differs")).alias("value"))
    return _given(stats, settings).unionByName(_section(assoc.mac_bins(stats), "mac_bins")).unionByName(_section(checks, "checks"))


def rare_checks(stats: DataFrame) -> DataFrame:
    """(check, left, right, ok): bins sum to the rows with a valid p, ids are unique, and every valid row has a minor allele."""
    ok = F.coalesce(assoc.valid_p(), F.lit(False))
    bins = assoc.mac_bins(stats).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("in_bins"))
    ids = stats.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    one = stats.agg(F.count_if(ok).alias("valid"), F.count_if(ok & (F.col("mac") > 0)).alias("with_mac")).join(F.broadcast(bins)).join(F.broadcast(ids))  # one row each
    pairs = {"mac_bins": ("in_bins", "valid"), "unique_ids": ("ids", "rows"), "minor_alleles": ("with_mac", "valid")}
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(a).alias("left"), F.col(b).alias("right"), (F.col(a) == F.col(b)).alias("ok")) for n, (a, b) in pairs.items()])
    return one.select(F.inline(rows))


def ancestry_prep_report(shared: DataFrame, pruned: DataFrame, mismatches: DataFrame, projection: DataFrame, settings: dict[str, str], min_n: int = 10_000, warn_n: int = 50_000) -> DataFrame:
    """Settings, counts, the status of the overlap, and each component's projection check (pc, n, r, passed)."""
    counts = {"shared_variants": shared, "pruned_variants": pruned, "exclusions": mismatches}
    out = _given(shared, settings)
    for name, table in counts.items():
        out = out.unionByName(_section(table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("k"), "n"), "counts"))
    gate = quality.overlap_gate(shared, min_n, warn_n).select(F.lit("shared_variants").alias("k"), "status")
    checks = projection.select("pc", F.concat(F.when(F.col("passed"), "pass").otherwise("fail"), F.lit(" abs(r)="), E.fmt_decimal(F.abs("r"), 3)).alias("value"))
    return out.unionByName(_section(gate, "status")).unionByName(_section(checks, "projection"))


def admixture_report(summaries: dict[str, DataFrame]) -> DataFrame:
    """(stratum, metric, value) of the proportion summaries of all strata."""
    return bind_strata(summaries, ["metric", "value"])


def has_chromosomes(v: DataFrame, chroms: list[str]) -> bool:
    """Whether any variant lies on one of chroms; the scan ends at the first."""
    return not v.filter(E.normalize_chrom("chrom").isin(*chroms)).isEmpty()
