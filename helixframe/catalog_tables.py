"""Registered queries of the scans and sinks, of variant tables and of column expressions; written files lie in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators import assoc, quality, samples, variants
from helixframe.plans.stored import shared_dir
from helixframe.registry import query
from helixframe.sources import io


def _path(df) -> str:
    return f"{shared_dir(df.sparkSession)}/text-{uuid.uuid4().hex}"


# ------------------------------------------------------------ scans and sinks


@query("SELECT id, chrom, CAST(pos AS VARCHAR) AS pos, coalesce(CAST(n AS VARCHAR), 'NA') AS n FROM sumstats", "sumstats")
def table_round_trip(v):
    df = v("sumstats").select("id", "chrom", "pos", "n")
    io.write_table(df, at := _path(df))
    return io.read_table(df.sparkSession, at)


@query("SELECT round(p, 7) AS p, chrom, pos, id, CAST(mac AS DOUBLE) AS beta FROM sumstats", "sumstats")
def assoc_scan(v):
    df = v("sumstats").select(F.col("chrom").alias("#CHROM"), F.col("pos").alias("GENPOS"), F.col("id").alias("ID"), F.col("mac").alias("BETA"), (-F.log10("p")).alias("LOG10P"), F.lit("unused").alias("EXTRA"))
    io.write_table(df, at := _path(df))
    return io.read_assoc(df.sparkSession, at).withColumn("p", F.round("p", 7))


@query("SELECT count(*) AS n FROM sumstats", "sumstats")
def record_count(v):
    df = v("sumstats").select("id", "chrom")
    df.write.csv(at := _path(df), sep="\t", header=True)
    return io.count_records(df.sparkSession, at)


@query("SELECT regexp_replace(chrom, '^chr', '') AS chrom, pos, id, ref, alt, info FROM variants_study", "variants_study")
def variant_scan(v):
    df = v("variants_study").select(E.strip_chr("chrom").alias("#CHROM"), F.col("pos").alias("POS"), F.col("id").alias("ID"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"), F.col("info").alias("INFO"))
    io.write_table(df, at := _path(df))
    return io.read_variants(df.sparkSession, at, "pvar")


@query("SELECT fid, iid FROM samples", "samples")
def sample_scan(v):
    df = v("samples").select("fid", "iid")
    io.write_ids(df, at := _path(df))
    return io.read_samples(df.sparkSession, at)


@query("SELECT row_number() OVER (ORDER BY sid) - 1 AS place, sid, sid AS first, 2 * sid AS second FROM pheno", "pheno")
def matrix_scan(v):
    df = v("pheno").orderBy("sid").select(F.concat_ws(" ", "sid", (2 * F.col("sid")).cast("string")).alias("value"))
    df.write.text(at := _path(df))
    rows = io.read_matrix(df.sparkSession, at, 2)
    named = io.number_samples(v("pheno").select("sid"), "sid")
    return named.join(rows, "place").select("place", "sid", F.col("values")[0].cast("long").alias("first"), F.col("values")[1].cast("long").alias("second"))


@query("SELECT chrom, pos AS start, pos + 50 AS \"end\", concat('g', vid) AS label FROM variants", "variants")
def interval_scan(v):
    df = v("variants").select(F.concat(F.lit("chr"), "chrom").alias("chrom"), F.col("pos").alias("start"), (F.col("pos") + 50).alias("end"), F.concat(F.lit("g"), "vid").alias("label"))
    io.write_ids(df, at := _path(df))
    return io.read_intervals(df.sparkSession, at, "bed")


@query("SELECT vid, CAST(chrom AS INTEGER) AS chrom, pos FROM variants", "variants")
def chrom_sink(v):
    io.write_by_chrom(v("variants"), at := _path(v("variants")))
    return v("variants").sparkSession.read.parquet(at).select("vid", F.col("chrom").cast("int").alias("chrom"), "pos")


@query("SELECT 'acctbal' AS trait, CASE WHEN mac % 2 = 0 THEN 'EUR' ELSE 'ALL' END AS ancestry, 'GRCh38' AS build, id, pos, p FROM sumstats", "sumstats")
def sumstats_sink(v):
    df = v("sumstats").select("*", F.lit("acctbal").alias("trait"), F.when(F.col("mac") % 2 == 0, "EUR").otherwise("ALL").alias("ancestry"), F.lit("GRCh38").alias("build"))
    io.write_sumstats(df, at := _path(df))
    return df.sparkSession.read.parquet(at).select("trait", "ancestry", "build", "id", "pos", "p")


@query("SELECT concat('k', p_partkey) AS key, CAST(p_size AS VARCHAR) AS value FROM part")
def key_value_sink(v):
    df = v("part").select(F.concat(F.lit("k"), "p_partkey").alias("key"), F.col("p_size").alias("value"))
    io.write_key_values(df, at := _path(df))
    return df.sparkSession.read.csv(at, sep="\t", schema="key string, value string")


@query("SELECT r_name AS role, 'GRCH38' AS build FROM region WHERE r_name = 'ASIA'")
def panel_choice(v):
    panels = v("region").select(F.col("r_name").alias("role"), F.lit("GRCH38").alias("build"))
    return io.select_panel(panels, "asia", "grch38")


@query("SELECT CAST(c_nationkey AS VARCHAR) AS name, sha256(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS sha256, CAST(sum(length(c_name) + 1) AS BIGINT) AS size_bytes FROM customer GROUP BY c_nationkey")
def inventory_of_files(v):
    df = v("customer").select("c_nationkey", "c_custkey", F.col("c_name").alias("value")).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    df.select("c_nationkey", "value").write.partitionBy("c_nationkey").text(at := _path(df))
    files = io.file_inventory(df.sparkSession, at)
    return files.select(F.regexp_extract("path", "c_nationkey=([0-9]+)/", 1).alias("name"), "sha256", "size_bytes")


# ------------------------------------------------------------ variants

SPOILT = "s AS (SELECT p_partkey AS row_number, CAST(1 + p_partkey % 22 AS VARCHAR) AS chrom, p_partkey * 97 AS pos, concat('rs', p_partkey) AS id, CASE WHEN p_partkey % 8 = 0 THEN 'g' ELSE 'A' END AS ref, CASE WHEN p_partkey % 16 = 0 THEN 'G,T' ELSE 'G' END AS alt FROM part)"


def _spoilt(v):
    k = F.col("p_partkey")
    return v("part").select(k.alias("row_number"), (1 + k % 22).cast("string").alias("chrom"), (k * 97).alias("pos"), F.concat(F.lit("rs"), k).alias("id"), F.when(k % 8 == 0, "g").otherwise("A").alias("ref"), F.when(k % 16 == 0, "G,T").otherwise("G").alias("alt"))


@query(f"WITH {SPOILT} SELECT row_number, id, concat('__invalid_bim_row_', row_number) AS replacement_id FROM s WHERE ref = 'g' AND alt = 'G'")
def invalid_alleles(v):
    return variants.invalid_alleles(_spoilt(v)).select("row_number", "id", "replacement_id")


@query(f"WITH {SPOILT} SELECT row_number, CASE WHEN ref = 'g' AND alt = 'G' THEN concat('__invalid_bim_row_', row_number) ELSE id END AS id, CASE WHEN ref = 'g' AND alt = 'G' THEN 'A' ELSE ref END AS ref, CASE WHEN ref = 'g' AND alt = 'G' THEN 'C' ELSE alt END AS alt FROM s")
def sanitized_variants(v):
    return variants.sanitize_variants(_spoilt(v)).select("row_number", "id", "ref", "alt")


@query("SELECT id FROM (SELECT concat('v', p_partkey - CASE WHEN p_partkey % 5 = 1 THEN 1 ELSE 0 END) AS id FROM part) z GROUP BY id HAVING count(*) = 1")
def unique_ids(v):
    return variants.drop_repeated(v("part").select(F.concat(F.lit("v"), F.col("p_partkey") - F.when(F.col("p_partkey") % 5 == 1, 1).otherwise(0)).alias("id")), "id")


INFOS = "i AS (SELECT concat('v', p_partkey) AS id, CASE p_partkey % 4 WHEN 0 THEN 'AF=1;R2=0.2' WHEN 1 THEN 'r2=9.5e-1;X' WHEN 2 THEN 'INFO=.;PR' ELSE 'INFO_SCORE=0.5' END AS info, p_partkey % 4 AS k FROM part)"


@query(f"WITH {INFOS} SELECT id, k <> 0 AS passed FROM i")
def info_filter(v):
    k = F.col("p_partkey") % 4
    rows = v("part").select(F.concat(F.lit("v"), "p_partkey").alias("id"), F.when(k == 0, "AF=1;R2=0.2").when(k == 1, "r2=9.5e-1;X").when(k == 2, "INFO=.;PR").otherwise("INFO_SCORE=0.5").alias("info"))
    found = variants.info_filter(rows, 0.3)
    return found.passed.select("id", F.lit(True).alias("passed")).unionByName(found.excluded.select("id", F.lit(False).alias("passed")))


@query("SELECT vid, CASE WHEN vid % 3 <> 0 THEN chrom WHEN pos * 1000 <= 2781479 THEN 'PAR1' WHEN pos * 1000 >= 155701383 THEN 'PAR2' ELSE 'X' END AS chrom FROM variants", "variants")
def par_split(v):
    on_x = v("variants").select("vid", F.when(F.col("vid") % 3 == 0, "chrX").otherwise(F.col("chrom")).alias("chrom"), (F.col("pos") * 1000).alias("pos"))
    return variants.split_par(on_x, "GRCh38").select("vid", "chrom")


@query("SELECT chrom, pos, count(*) AS n FROM (SELECT regexp_replace(chrom, '^chr', '') AS chrom, pos FROM variants_ref WHERE ref <> alt) z GROUP BY 1, 2 HAVING count(*) > 1", "variants_ref")
def crowded_loci(v):
    return variants.crowded_loci(v("variants_ref"), 1)


@query("""SELECT concat('v', p_partkey) AS variant_id, CASE WHEN p_partkey % 6 = 0 THEN 'missing_build' WHEN p_partkey % 10 = 1 THEN 'ambiguous_mapping' WHEN p_partkey % 7 = 0 THEN 'different_chromosome' WHEN p_partkey % 5 = 0 THEN 'positions_too_close' ELSE 'ok' END AS reason FROM part""")
def discriminating_markers(v):
    k = F.col("p_partkey")
    first = v("part").select(F.concat(F.lit("v"), k).alias("variant_id"), (k % 22).cast("string").alias("chrom"), (k * 1000).alias("pos"), k.alias("k"))
    other = first.filter("k % 6 <> 0").withColumns({"chrom": F.when(F.col("k") % 7 == 0, "x").otherwise(F.col("chrom")), "pos": F.col("pos") + F.when(F.col("k") % 5 == 0, 3).otherwise(900)})
    return variants.discriminating_markers(first.unionByName(first.filter("k % 10 = 1 and k % 6 <> 0")).drop("k"), other.drop("k"), 100)


@query("SELECT p_size, min(p_partkey) AS p_partkey FROM part GROUP BY p_size")
def first_by_size(v):
    return variants.first_by(v("part").select("p_size", "p_partkey"), ["p_size"], ["p_partkey"])


@query("SELECT count(*) FILTER (WHERE vid % 6 = 0) AS x, count(*) FILTER (WHERE vid % 6 = 1) AS y, count(*) FILTER (WHERE vid % 6 = 2) AS xy, count(*) FILTER (WHERE vid % 6 = 3) AS par1, 0 AS par2, count(*) FILTER (WHERE vid % 4 = 0) AS invalid_alleles, count(*) FILTER (WHERE vid % 5 = 0) AS with_info FROM variants", "variants")
def variant_scan_summary(v):
    k = F.col("vid") % 6
    rows = v("variants").withColumns({"chrom": F.when(k == 0, "chrX").when(k == 1, "24").when(k == 2, "XY").when(k == 3, "par1").otherwise(F.col("chrom")), "ref": F.lit("A"), "alt": F.when(F.col("vid") % 4 == 0, "a").otherwise("G"), "info": F.when(F.col("vid") % 5 == 0, "PR").otherwise(".")})
    return variants.variant_scan_summary(rows)


@query("WITH r AS (SELECT chrom, pos, (vid * 7919) % 1009 AS rn, vid FROM variants), o AS (SELECT chrom, pos < lag(pos) OVER (PARTITION BY chrom ORDER BY rn * 100000 + vid) AS back FROM r) SELECT chrom, count(*) FILTER (WHERE back) AS n FROM o GROUP BY chrom HAVING count(*) FILTER (WHERE back) > 0", "variants")
def unsorted_rows(v):
    return variants.unsorted_rows(v("variants").withColumn("row_number", (F.col("vid") * 7919) % 1009 * 100000 + F.col("vid")))


@query("SELECT DISTINCT id FROM (SELECT id FROM variants_ref UNION ALL SELECT id FROM variants_study) u", "variants_ref", "variants_study")
def sorted_ids(v):
    return variants.sorted_ids(v("variants_ref"), v("variants_study"))


@query("SELECT CASE WHEN vid % 2 = 0 THEN concat('new', vid) ELSE concat('v', vid) END AS id, pos FROM variants WHERE vid % 3 <> 0 AND vid % 5 <> 0", "variants")
def renamed_variants(v):
    named = v("variants").withColumn("id", F.concat(F.lit("v"), "vid"))
    kept = variants.exclude(variants.extract(named, named.filter("vid % 3 <> 0")), named.filter("vid % 5 = 0"))
    return variants.rename_variants(kept, named.filter("vid % 2 = 0").select("id", F.concat(F.lit("new"), "vid").alias("new_id"))).select("id", "pos")


@query("SELECT 'GRCh37' AS build, gate FROM (SELECT 'fraction' AS gate UNION ALL SELECT 'margin' UNION ALL SELECT 'fraction_margin') g WHERE (SELECT count(*) FROM variants) > 0", "variants")
def build_gates(v):
    n = v("variants").agg(F.count(F.lit(1)).alias("n"))
    scores = n.select(F.inline(F.array(F.struct(F.lit("GRCh37").alias("build"), F.col("n").alias("matched"), (2 * F.col("n")).alias("checked"), F.lit(0.5).alias("fraction"), F.lit(1).alias("rank"), F.lit(0).alias("margin"), F.lit(0.0).alias("fraction_margin")))))
    return variants.build_gates(scores, min_fraction_margin=0.1)


@query("SELECT id, least(ref, alt) AS lo FROM variants_ref WHERE id LIKE 'rs%'", "variants_ref")
def rsid_alleles(v):
    return v("variants_ref").filter(E.is_rsid("id")).select("id", F.least("ref", "alt").alias("lo"))


# ------------------------------------------------------------ column expressions


@query("""SELECT p_partkey, CASE p_partkey % 12 WHEN 0 THEN '7' WHEN 1 THEN 'X' WHEN 2 THEN 'Y' WHEN 3 THEN 'XY' WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN 'MT' WHEN 7 THEN 'GL1' WHEN 8 THEN 'PAR1' WHEN 9 THEN NULL WHEN 10 THEN 'X' ELSE '22' END AS label,
CASE p_partkey % 12 WHEN 0 THEN 7 WHEN 1 THEN 23 WHEN 2 THEN 24 WHEN 3 THEN 25 WHEN 6 THEN 26 WHEN 10 THEN 23 WHEN 11 THEN 22 END AS key, CASE p_partkey % 12 WHEN 0 THEN '7' WHEN 1 THEN 'X' WHEN 2 THEN 'Y' WHEN 3 THEN 'X' WHEN 6 THEN 'MT' WHEN 7 THEN 'GL1' WHEN 8 THEN 'X' WHEN 10 THEN 'X' WHEN 11 THEN '22' END AS collapsed FROM part""")
def chromosome_labels(v):
    given = ["chr7", "23", "24", "chr25", "", "0", "mt", " gl1", "CHRpar1", "NA", "chrx", "22"]
    c = F.element_at(F.array(*map(F.lit, given)), (F.col("p_partkey") % 12 + 1).cast("int"))
    rows = v("part").select("p_partkey", c.alias("c"))
    return rows.select("p_partkey", E.normalize_chrom("c").alias("label"), E.chrom_key("c").alias("key"), E.collapse_par("c").alias("collapsed"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 1.5 WHEN 1 THEN -200.0 WHEN 4 THEN 0.5 END AS number, CASE p_partkey % 6 WHEN 0 THEN 'a_b' WHEN 1 THEN 'x.y_z' ELSE 'q' END AS name, CASE WHEN p_partkey % 2 = 0 THEN 'B' ELSE 'A' END AS first,
round(power(10, -CAST(p_partkey % 5 AS DOUBLE)), 9) AS p, printf('%.3f', CAST(p_partkey AS DOUBLE) / 7) AS decimal, printf('%.6f', 100.0::DOUBLE * (p_partkey % 9) / 9) AS percent, len(string_split(p_name, ' ')) AS n_words, concat_ws('__', 'bt', p_brand) AS group_id FROM part""")
def expressions(v):
    k = F.col("p_partkey")
    number = F.element_at(F.array(*map(F.lit, ["1.5", "-2e2", "inf", "1e999", ".5", "1d"])), (k % 6 + 1).cast("int"))
    name = F.when(k % 6 == 0, "*a / b*").when(k % 6 == 1, "x.y_z").otherwise("  q!")
    return v("part").select(
        "p_partkey", E.finite(number).alias("number"), E.safe_name(name).alias("name"), E.first_value(F.when(k % 2 == 0, ".").otherwise("A"), F.lit("B")).alias("first"), F.round(E.p_from_log10((k % 5).cast("string")), 9).alias("p"),
        E.fmt_decimal(k / 7, 3).alias("decimal"), E.fmt_percent(k % 9, F.lit(9)).alias("percent"), F.size(E.split_csv(F.regexp_replace("p_name", " ", " ,"))).alias("n_words"), E.group_id(F.lit("bt"), "p_brand").alias("group_id"),
    )


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_partkey > 0 THEN round(ln(CAST(p_partkey AS DOUBLE)), 6) WHEN p_partkey % 3 = 1 THEN CAST(0.25 AS DOUBLE) END AS beta, concat('n', p_size, ';', p_partkey) AS collapsed FROM part")
def effects(v):
    k = F.col("p_partkey")
    rows = v("part").select("p_partkey", "p_size", F.when(k % 3 == 1, "0.25").otherwise("NA").alias("b"), F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, "9").otherwise("-1").alias("o"))
    return rows.select("p_partkey", F.round(E.log_odds("b", "o"), 6).alias("beta"), E.collapse(F.array(F.concat(F.lit("n"), "p_size"), F.concat(F.lit("n"), "p_size"), F.col("p_partkey").cast("string"))).alias("collapsed"))


@query("SELECT DISTINCT CASE WHEN x THEN 'bt' ELSE 'qt' END AS kind FROM (SELECT true AS x FROM samples UNION ALL SELECT false FROM samples) z", "samples")
def trait_types(v):
    s = v("samples")
    kinds = [samples.trait_type(s, "case_trait", "1", "0"), samples.trait_type(s, "quant_trait")]
    return s.select(F.explode(F.array(*map(F.lit, kinds))).alias("kind")).distinct()


@query("SELECT iid FROM samples WHERE age > 40", "samples")
def subtracted_ids(v):
    return samples.missing_from(v("samples"), v("samples").filter("age <= 40"), ["fid", "iid"]).select("iid")


@query("SELECT fid, count(*) AS n FROM (SELECT concat('f', c_custkey % 100) AS fid FROM customer) z GROUP BY fid HAVING count(*) > 1")
def repeated_keys(v):
    return quality.duplicates(v("customer").select(F.concat(F.lit("f"), F.col("c_custkey") % 100).alias("fid")), "fid")


@query("SELECT id, p, chrom, pos, row_id, mac - 1.0 AS lci, mac + 1.0 AS uci, mac / 100.0 AS aaf, mac / 100.0 AS maf, mac FROM (SELECT *, row_number() OVER (ORDER BY p, row_id) AS k FROM sumstats WHERE p > 0 AND p <= 1) z WHERE k <= 10", "sumstats")
def top_hits_rare(v):
    m = F.col("mac")
    return assoc.top_hits(v("sumstats").withColumns({"lci": (m - 1).cast("double"), "uci": (m + 1).cast("double"), "aaf": m / 100, "maf": m / 100}), rare=True)
