"""Variant tables (chrom, pos, id, ref, alt, info): eligibility, repair, harmonization, intervals, build inference."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import expr as E

#: Range joins bin positions to this width.
BIN = 1 << 14
# The last base of PAR1 and the first of PAR2 on X, by build.
PAR_BOUNDS = {"GRCh37": (2699520, 154931044), "GRCh38": (2781479, 155701383)}
QUALITY_KEYS = ["R2", "INFO", "MACH_R2", "MINIMAC3_R2", "IMPUTE_INFO", "IMPUTE2_INFO", "INFO_SCORE", "RSQ"]


def is_eligible() -> Column:
    """Autosomal biallelic ACGT variants with a position and an id."""
    chrom = E.strip_chr("chrom").try_cast("int").between(1, 22)
    alleles = F.col("ref").rlike("(?i)^[ACGT]+$") & F.col("alt").rlike("(?i)^[ACGT]+$") & (F.upper("ref") != F.upper("alt"))
    return F.coalesce(chrom & (F.col("pos") > 0) & ~F.col("id").isin("", ".") & alleles, F.lit(False))


def eligible_variants(v: DataFrame) -> DataFrame:
    """Eligible rows with chromosome numbers and upper-case alleles."""
    number = E.strip_chr("chrom").try_cast("int").cast("string")
    return v.filter(is_eligible()).withColumns({"chrom": number, "ref": F.upper("ref"), "alt": F.upper("alt")})


def scan_summary(v: DataFrame) -> DataFrame:
    return v.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(is_eligible()).alias("eligible"), F.count_if(~is_eligible()).alias("excluded"))


def _invalid() -> Column:
    return (F.upper("ref") == F.upper("alt")) & (F.col("ref") != "") & ~F.contains(F.col("alt"), F.lit(","))


def invalid_alleles(v: DataFrame, kind: str = "bim") -> DataFrame:
    """Rows (with row_number) whose two alleles are the same code, and the id that replaces theirs."""
    new = F.concat(F.lit(f"__invalid_{kind}_row_"), F.col("row_number").cast("string"))
    return v.filter(_invalid()).withColumn("replacement_id", new)


def sanitize_variants(v: DataFrame, kind: str = "bim") -> DataFrame:
    """v with the replacement id and alleles A and C in invalid rows."""
    new = F.concat(F.lit(f"__invalid_{kind}_row_"), F.col("row_number").cast("string"))
    bad = F.coalesce(_invalid(), F.lit(False))
    return v.withColumn("bad", bad).withColumns({"id": F.when(F.col("bad"), new).otherwise(F.col("id")), "ref": F.when(F.col("bad"), "A").otherwise(F.col("ref")), "alt": F.when(F.col("bad"), "C").otherwise(F.col("alt"))}).drop("bad")


def drop_repeated(v: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys no other row has. Counts meet in an aggregate, so a key with many rows is no single task."""
    once = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")
    return v.join(once, list(keys), "left_semi")


class Quality(NamedTuple):
    metric: str | None
    passed: DataFrame
    excluded: DataFrame


def info_filter(v: DataFrame, threshold: float, table_columns: tuple[str, ...] = ()) -> Quality:
    """Imputation quality. The first metric with a finite value anywhere counts; missing values pass."""
    candidates = {f"column:{c}": E.finite(c) for c in ("R2", "INFO") if c in table_columns}
    if "info" in v.columns:
        candidates["INFO keys"] = F.coalesce(*[E.finite(E.info_value("info", k)) for k in QUALITY_KEYS])
    candidates |= {f"column:{c}": E.finite(c) for c in QUALITY_KEYS[2:] if c in table_columns}
    counts = v.agg(*[F.count(c).alias(n) for n, c in candidates.items()]).first().asDict() if candidates else {}
    metric = next((n for n in candidates if counts[n]), None)
    named = v.filter(~F.col("id").isin("", ".", "NA"))
    if metric is None:
        return Quality(None, named, v.limit(0).withColumn("reason", F.lit("")))
    low = F.coalesce(candidates[metric] < threshold, F.lit(False))
    return Quality(metric, named.filter(~low), v.filter(low).withColumn("reason", F.lit("info_r2_below_min")))


def split_par(v: DataFrame, build: str) -> DataFrame:
    """v with the X rows of the pseudo-autosomal regions as PAR1 and PAR2; a table that has such rows is split already."""
    if build not in PAR_BOUNDS:
        raise ValueError(f"unknown build {build}")
    low, high = PAR_BOUNDS[build]
    label = E.normalize_chrom("chrom")
    if not v.filter(label.isin("PAR1", "PAR2")).isEmpty():
        return v.withColumn("chrom", label)
    return v.withColumn("chrom", F.when((label == "X") & (F.col("pos") <= low), "PAR1").when((label == "X") & (F.col("pos") >= high), "PAR2").otherwise(label))


#: Rows of one side that a locus may have.
LOCUS_ROWS = 10_000


class Harmonized(NamedTuple):
    mapping: DataFrame
    mismatches: DataFrame


def harmonize_variants(ref: DataFrame, study: DataFrame, exclude_palindromic: bool = True) -> Harmonized:
    """Matches eligible variants by locus and unordered alleles; over LOCUS_ROWS rows of one side at a locus are an error.

    Both sides are dealt by locus once and sorted there. The limit, the allele keys of both sides and the
    roll-up of a locus's keys all follow that order without another shuffle; what a task holds is a locus.
    """
    def sided(v: DataFrame, is_ref: bool) -> DataFrame:
        e = eligible_variants(v).withColumn("provisional", E.info_flag("info", "PR"))
        return e.select("chrom", "pos", F.least("ref", "alt").alias("lo"), F.greatest("ref", "alt").alias("hi"), F.lit(is_ref).alias("is_ref"), F.struct("chrom", "pos", "ref", "alt", "id", "provisional").alias("row"))

    place = F.row_number().over(Window.partitionBy("chrom", "pos", "is_ref").orderBy("lo", "hi"))
    crowded = F.raise_error(F.format_string(f"more than {LOCUS_ROWS} records at locus %s:%s", "chrom", F.col("pos").cast("string"))).cast("boolean")
    rows = sided(ref, True).unionByName(sided(study, False)).repartition("chrom", "pos").withColumn("place", place).filter(F.when(F.col("place") > LOCUS_ROWS, crowded).otherwise(True))
    own, other = F.col("is_ref"), ~F.col("is_ref")
    both = rows.groupBy("chrom", "pos", "lo", "hi").agg(
        F.count_if(own).alias("rn"), F.count_if(other).alias("sn"), F.array_sort(F.collect_list(F.when(own, F.col("row")))).alias("rr"), F.array_sort(F.collect_list(F.when(other, F.col("row")))).alias("sr")
    )
    rn, sn = F.col("rn"), F.col("sn")
    r, s = F.get("rr", F.lit(0)), F.get("sr", F.lit(0))
    known_r, known_s = ~r["provisional"], ~s["provisional"]
    source = (
        F.when(E.is_rsid(r["id"]), "reference_rsid").when(E.is_rsid(s["id"]), "study_rsid").when(known_r, "reference_pvar_known_ref").when(known_s, "study_pvar_known_ref")
    )
    state = (
        F.when((rn > 1) & (sn > 1), "duplicate_locus_allele_key_both").when(rn > 1, "duplicate_locus_allele_key_reference").when(sn > 1, "duplicate_locus_allele_key_study")
        .when((rn == 0) | (sn == 0), "unmatched")
    )
    if exclude_palindromic:
        state = state.when(E.is_palindromic("lo", "hi"), "palindromic_snp_excluded")
    state = state.when(known_r & known_s & (r["ref"] != s["ref"]), "pvar_known_ref_disagreement").when(source.isNull(), "no_pvar_known_ref_for_cpra").otherwise("retained")
    judged = both.withColumns({"state": state, "source": source, "r": r, "s": s})

    def c(side: str) -> Column:
        return E.cpra(f"{side}.chrom", f"{side}.pos", f"{side}.ref", f"{side}.alt")

    chosen = F.when(F.col("source") == "reference_rsid", F.col("r.id")).when(F.col("source") == "study_rsid", F.col("s.id")).when(F.col("source") == "reference_pvar_known_ref", c("r")).otherwise(c("s"))
    mapping = judged.filter("state = 'retained'").select(
        chosen.alias("harmonized_id"), F.when(F.col("source").endswith("rsid"), "rsID").otherwise("CPRA").alias("harmonized_id_type"), F.col("source").alias("harmonized_id_source"),
        F.lit("locus_and_unordered_alleles").alias("match_rule"), F.col("r.id").alias("reference_id"), F.col("s.id").alias("study_id"), "chrom", "pos",
        F.col("r.ref").alias("reference_ref"), F.col("r.alt").alias("reference_alt"), F.col("s.ref").alias("study_ref"), F.col("s.alt").alias("study_alt"),
        F.when(F.col("r.ref") == F.col("s.ref"), "same").otherwise("ref_alt_swap").alias("orientation"),
        F.col("r.provisional").alias("reference_provisional"), F.col("s.provisional").alias("study_provisional"),
        ((F.col("source") == "reference_rsid") & E.is_rsid("s.id") & (F.col("r.id") != F.col("s.id"))).alias("differing_rsid"),
    )
    by_key = judged.filter(~F.col("state").isin("retained", "unmatched")).select(
        F.col("state").alias("reason"), F.when((rn > 0) & (sn > 0), "both").when(rn > 0, "reference").otherwise("study").alias("excluded_side"),
        "chrom", "pos", "rr", "sr",
    )
    # valid keys are unique on their side
    valid = judged.filter("state not like 'duplicate%'")
    lone_r, lone_s = (F.col("state") == "unmatched") & (sn == 0), (F.col("state") == "unmatched") & (rn == 0)
    locus = valid.groupBy("chrom", "pos").agg(
        F.collect_list(F.when(lone_r, F.col("r"))).alias("ur"), F.collect_list(F.when(lone_s, F.col("s"))).alias("us"), F.collect_list("r").alias("vr"), F.collect_list("s").alias("vs")
    ).filter("(size(ur) > 0 or size(us) > 0) and size(vr) > 0 and size(vs) > 0")
    leftover = locus.select(
        F.lit("allele_mismatch").alias("reason"), F.when((F.size("ur") > 0) & (F.size("us") > 0), "both").when(F.size("ur") > 0, "reference").otherwise("study").alias("excluded_side"),
        "chrom", "pos", F.array_sort(F.when(F.size("ur") > 0, F.col("ur")).otherwise(F.col("vr"))).alias("rr"), F.array_sort(F.when(F.size("us") > 0, F.col("us")).otherwise(F.col("vs"))).alias("sr"),
    )

    def collapsed(rows: str, field: str) -> Column:
        return F.array_join(F.array_distinct(F.transform(rows, lambda x: x[field].cast("string"))), ";")

    mismatches = by_key.unionByName(leftover).select(
        "reason", "excluded_side", *[collapsed(rows, f).alias(f"{side}_{f}") for f in ("id", "ref", "alt", "provisional") for side, rows in (("reference", "rr"), ("study", "sr"))], "chrom", "pos"
    )
    return Harmonized(mapping, mismatches)


def check_id_integrity(mapping: DataFrame) -> DataFrame:
    """Harmonized ids that name several loci or several variants of one."""
    per = mapping.groupBy("harmonized_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("chrom", "pos").alias("loci"))
    return per.filter("n > 1").select("harmonized_id", F.when(F.col("loci") > 1, "multiple loci").otherwise("multiple variants at locus").alias("problem"))


def disjoint_intervals(iv: DataFrame, zero_based: bool = False) -> DataFrame:
    """(chrom, start, end) of the merged intervals, disjoint and not adjoining, in the same convention; those that end before they start go."""
    touch = 0 if zero_based else 1  # from this gap on, two intervals stay apart
    rows = iv.select("chrom", "start", "end").filter("start < end" if zero_based else "start <= end")
    order = Window.partitionBy("chrom").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("new", F.coalesce((F.col("start") > reach + touch).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return opened.groupBy("chrom", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).select("chrom", "start", "end")


def in_intervals(v: DataFrame, iv: DataFrame, n_intervals: int | None = None, zero_based: bool = False) -> DataFrame:
    """Rows of v inside any interval: 1-based inclusive, or 0-based half-open. n_intervals is no longer needed.

    Merged intervals are cut at the borders of bins of BIN bases. As they are disjoint, the pieces are at most the
    intervals and the genome's bins, however long an interval is; Spark broadcasts them if their size allows.
    """
    at = F.col("pos") - 1 if zero_based else F.col("pos")
    last = F.col("end") - 1 if zero_based else F.col("end")
    merged = disjoint_intervals(iv, zero_based).select("chrom", F.col("start").alias("__low"), last.alias("__high"))
    pieces = merged.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("__low") / BIN), F.floor(F.col("__high") / BIN))))
    probe = v.withColumns({"__at": at, "__bin": F.floor(at / BIN)})
    met = (probe.chrom == pieces.chrom) & (probe["__bin"] == pieces["__bin"]) & probe["__at"].between(pieces["__low"], pieces["__high"])
    return probe.join(pieces, met, "left_semi").drop("__at", "__bin")


def gene_containment(index: DataFrame, v: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene, inside, outside): indexed variants within and beyond their gene's bounds (1-based inclusive)."""
    joined = index.join(v.select("id", "pos"), "id").join(genes.select("gene", "start", "end"), "gene")
    inside = F.col("pos").between(F.col("start"), F.col("end"))
    return joined.groupBy("gene").agg(F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"))


def match_build_markers(v: DataFrame, markers: DataFrame) -> DataFrame:
    """(build, supports) of each candidate row against the marker table: by id, else by position.

    The marker table is small and fixed (thousands of rows); Spark broadcasts it if its size allows.
    """
    rows = v.select(F.monotonically_increasing_id().alias("row"), E.strip_chr("chrom").alias("vc"), F.col("pos").alias("vp"), "id")
    ids = markers.select(F.col("variant_id").alias("id"), "build", "chrom", F.col("pos").alias("mp"))
    known = rows.join(ids.select("id").distinct(), "id", "left_semi").join(ids, "id").select("row", "build", ((F.col("vc") == F.col("chrom")) & (F.col("vp") == F.col("mp"))).alias("supports"))
    rest = rows.join(ids.select("id").distinct(), "id", "left_anti")
    placed = rest.join(ids.select(F.col("chrom").alias("vc"), F.col("mp").alias("vp"), "build").distinct(), ["vc", "vp"]).select("row", "build", F.lit(True).alias("supports"))
    return known.unionByName(placed)


def score_builds(matches: DataFrame) -> DataFrame:
    """(build, matched, checked, fraction, rank, margin, fraction_margin): best build first, ties by name; the winner's lead over the second."""
    checked = matches.agg(F.countDistinct("row").alias("checked"))
    per = matches.groupBy("build").agg(F.count_if("supports").alias("matched"))
    scored = per.join(F.broadcast(checked)).withColumn("fraction", F.col("matched") / F.col("checked"))  # one row
    ordered = scored.selectExpr("*", "row_number() over (order by matched desc, build) as rank", "coalesce(lead(matched) over (order by matched desc, build), 0) as second")  # a row for each build
    margin = F.when(F.col("rank") == 1, F.col("matched") - F.col("second"))
    return ordered.withColumns({"margin": margin, "fraction_margin": margin / F.col("checked")}).drop("second")


def build_gates(scores: DataFrame, min_markers: int = 3, min_fraction: float = 0.8, min_margin: int = 1, min_fraction_margin: float = 0.0) -> DataFrame:
    """(build, gate): the gates that the winner of score_builds fails; no rows if it may be taken."""
    tests = {
        "no_match": F.col("matched") == 0, "markers": F.col("matched") < min_markers, "fraction": F.col("fraction") < min_fraction, "margin": F.col("margin") < min_margin,
        "fraction_margin": F.col("fraction_margin") < min_fraction_margin,
    }
    failed = F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))
    return scores.filter("rank = 1").select("build", F.explode(failed).alias("gate"))


def crowded_loci(v: DataFrame, most: int = LOCUS_ROWS) -> DataFrame:
    """(chrom, pos, n) of eligible loci with more rows than harmonization should gather in one place."""
    return eligible_variants(v).groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)


def extract(v: DataFrame, ids: DataFrame) -> DataFrame:
    return v.join(ids.select("id"), "id", "left_semi")


def exclude(v: DataFrame, ids: DataFrame) -> DataFrame:
    return v.join(ids.select("id"), "id", "left_anti")


def rename_variants(v: DataFrame, mapping: DataFrame) -> DataFrame:
    """v under the new ids of mapping (id, new_id); variants it lacks keep theirs."""
    return v.join(mapping.select("id", "new_id"), "id", "left").withColumn("id", F.coalesce("new_id", "id")).select(*v.columns)


def sorted_ids(*tables: DataFrame) -> DataFrame:
    """The different ids of all tables in order."""
    return reduce(DataFrame.unionByName, [t.select("id") for t in tables]).distinct().orderBy("id")


def variant_scan_summary(v: DataFrame) -> DataFrame:
    label = F.upper(E.strip_chr("chrom"))
    groups = {"x": ["X", "23"], "y": ["Y", "24"], "xy": ["XY", "25"], "par1": ["PAR1"], "par2": ["PAR2"]}
    return v.agg(*[F.count_if(label.isin(*names)).alias(n) for n, names in groups.items()], F.count_if(_invalid()).alias("invalid_alleles"), F.count_if(F.coalesce(F.col("info"), F.lit(".")) != ".").alias("with_info"))


def chrom_coverage(v: DataFrame) -> DataFrame:
    """(chrom, n) of the 22 autosomes, zeros included."""
    labels = v.sparkSession.range(1, 23).select(F.col("id").cast("string").alias("chrom"))
    return labels.join(v.groupBy(E.strip_chr("chrom").alias("chrom")).agg(F.count(F.lit(1)).alias("n")), "chrom", "left").select("chrom", F.coalesce("n", F.lit(0)).alias("n"))


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first in order."""
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r"))
    return best.select("r.*")


#: Rows of a chromosome are compared in stretches of so many row numbers.
STRETCH = 1 << 16


def unsorted_rows(v: DataFrame) -> DataFrame:
    """(chrom, n): how many rows come before their predecessor on their chromosome, in the order of row_number.

    A window holds one stretch of rows; each stretch's last position is handed to the next that has rows.
    """
    cut = v.select("chrom", "pos", "row_number", F.floor(F.col("row_number") / STRETCH).alias("s"))
    ends = cut.groupBy("chrom", "s").agg(F.max_by("pos", "row_number").alias("last")).selectExpr("chrom", "s", "lag(last) over (partition by chrom order by s) as given")
    rows = cut.join(ends, ["chrom", "s"]).selectExpr("chrom", "pos < coalesce(lag(pos) over (partition by chrom, s order by row_number), given) as back")
    return rows.groupBy("chrom").agg(F.count_if("back").alias("n")).filter("n > 0")


def pass_union(*lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct ids of all lists, ids of each list and of their UNION)."""
    tagged = reduce(DataFrame.unionByName, [d.select("id", F.lit(f"list{i}").alias("list")) for i, d in enumerate(lists, 1)])
    rolled = tagged.rollup("list").agg(F.countDistinct("id").alias("n"))
    return tagged.select("id").distinct(), rolled.select(F.coalesce("list", F.lit("UNION")).alias("list"), "n")


def discriminating_markers(map37: DataFrame, map38: DataFrame, min_delta: int) -> DataFrame:
    """(variant_id, reason): ok where both builds place the id once, on one chromosome, at least min_delta apart."""
    def placed(m: DataFrame, tag: str) -> DataFrame:
        return m.groupBy("variant_id").agg(F.count(F.lit(1)).alias(f"n{tag}"), F.min("chrom").alias(f"c{tag}"), F.min("pos").alias(f"p{tag}"))

    both = placed(map37, "37").join(placed(map38, "38"), "variant_id", "full_outer")
    reason = (
        F.when(F.col("n37").isNull() | F.col("n38").isNull(), "missing_build").when((F.col("n37") > 1) | (F.col("n38") > 1), "ambiguous_mapping")
        .when(F.col("c37") != F.col("c38"), "different_chromosome").when(F.abs(F.col("p37") - F.col("p38")) < min_delta, "positions_too_close").otherwise("ok")
    )
    return both.select("variant_id", reason.alias("reason"))
