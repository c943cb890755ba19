"""Registered queries of the checks, and of the operators on samples and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators import ancestry, assoc, genotype, manifest, pooled, quality, ridge, samples, summaries, variants
from helixframe.registry import query, r6

# ------------------------------------------------------------ association

@query("""WITH w AS (SELECT vid, CAST(g AS DOUBLE) AS g, y, CAST(pop AS DOUBLE) AS x FROM calls JOIN pheno USING (sid) WHERE g IS NOT NULL AND y IS NOT NULL AND pop IS NOT NULL),
s AS (SELECT vid, count(*) AS n, sum(x * x) - sum(x) * sum(x) / count(*) AS xx, sum(x * g) - sum(x) * sum(g) / count(*) AS xg, sum(x * y) - sum(x) * sum(y) / count(*) AS xy, sum(g * g) - sum(g) * sum(g) / count(*) AS gg, sum(g * y) - sum(g) * sum(y) / count(*) AS gy, sum(y * y) - sum(y) * sum(y) / count(*) AS yy FROM w GROUP BY vid),
r AS (SELECT vid, n, CASE WHEN xx > 1e-9 THEN gg - xg * xg / xx ELSE gg END AS gg, CASE WHEN xx > 1e-9 THEN gy - xg * xy / xx ELSE gy END AS gy, CASE WHEN xx > 1e-9 THEN yy - xy * xy / xx ELSE yy END AS yy FROM s)
SELECT vid, n, round(gy / gg, 4) AS beta FROM r WHERE gg > 1e-6 AND n > 3""", "calls", "pheno")
def linear_assoc_covariate(v):
    return assoc.linear_assoc(v("calls"), v("pheno"), ["pop"]).select("vid", "n", F.round("beta", 4).alias("beta"))


@query("""SELECT sid, vid, CASE WHEN chrom = '22' AND sid % 2 = 1 THEN 2 * g ELSE g END AS g FROM calls JOIN variants USING (vid)""", "calls", "variants")
def male_x_coding(v):
    x = v("variants").withColumn("chrom", F.when(F.col("chrom") == "22", "X").otherwise(F.col("chrom")))
    return assoc.male_x(v("calls"), x, v("pheno").filter("sid % 2 = 1"))


@query("""WITH m AS (SELECT avg(y) AS m, stddev_samp(y) AS s FROM pheno) SELECT sid, round((y - m) / s, 6) AS y FROM pheno, m""", "pheno")
def standardized(v):
    return assoc.standardize(v("pheno"), ["y"]).select("sid", r6("y"))


@query("""WITH m AS (SELECT avg(age) AS m FROM samples) SELECT iid, round(power(age - m, 2), 6) AS age2 FROM samples, m""", "samples")
def centered_age(v):
    return assoc.centered_square(v("samples"), "age", "age2").select("iid", r6("age2"))


@query("""WITH o AS (SELECT sid, y, rank() OVER (ORDER BY y) AS low, count(*) OVER (PARTITION BY y) AS ties FROM pheno WHERE y IS NOT NULL)
SELECT sid, round(low + (ties - 1) / 2.0, 6) AS mean_rank FROM o""", "pheno")
def inverse_normal_ranks(v):
    out = assoc.rank_inverse_normal(v("pheno"), "y", "sid", "z")
    # the rank is read back from the quantile by its order: equal z, equal rank
    per = out.filter("z is not null").groupBy("z").agg(F.count(F.lit(1)).alias("ties"))
    ranks = assoc.ranked(per, ["z"], "k").select("z", "ties", "k")
    before = ranks.alias("a").select("z", "ties", F.col("k"))
    running = before.selectExpr("z", "sum(ties) over (order by k rows between unbounded preceding and current row) as upto", "ties")
    return out.join(running, "z").select("sid", F.round(F.col("upto") - (F.col("ties") - 1) / 2.0, 6).alias("mean_rank"))


@query("SELECT id, 'ADD' AS \"TEST\" FROM sumstats WHERE mac <> 7", "sumstats")
def test_terms(v):
    raw = v("sumstats").select("id", F.when(F.col("mac") == 7, "DOMDEV").otherwise("ADD").alias("TEST"))
    return assoc.filter_test(raw, "ADD")


VALID = "p > 0 AND p <= 1"


@query(f"""WITH a AS (SELECT chrom, count(*) AS n FROM sumstats GROUP BY chrom HAVING NOT coalesce(try_cast(chrom AS INTEGER) BETWEEN 1 AND 22 OR chrom = 'X', false))
SELECT chrom AS metric, CAST(n AS DOUBLE) AS found, 'label' AS problem FROM a
UNION ALL SELECT 'total_variants', CAST(count(*) AS DOUBLE), 'differs' FROM sumstats
UNION ALL SELECT 'valid_p', CAST(count(*) FILTER (WHERE {VALID}) AS DOUBLE), 'differs' FROM sumstats
UNION ALL SELECT 'min_p', min(p) FILTER (WHERE {VALID}), 'missing' FROM sumstats""", "sumstats")
def metrics_reconciled(v):
    given = assoc.assoc_metrics(v("sumstats").filter("chrom <> 'Y'")).filter("metric <> 'min_p'")
    given = given.filter("metric in ('total_variants', 'valid_p')").unionByName(assoc.assoc_metrics(v("sumstats")).filter("metric not in ('total_variants', 'valid_p', 'min_p')"))
    return assoc.reconcile_metrics(v("sumstats"), given).select("metric", "found", "problem")


@query("""WITH e AS (SELECT id, CAST(mac AS DOUBLE) / 94 AS maf, p, CASE WHEN mac % 9 > 0 THEN log2(mac % 9) END AS y FROM sumstats),
k AS (SELECT *, row_number() OVER (ORDER BY maf, p NULLS FIRST, id) AS k FROM e WHERE maf > 0 AND maf <= 0.5 AND y IS NOT NULL)
SELECT id, round(maf, 6) AS maf, round(y, 6) AS y FROM k WHERE k % 2 = 1 OR p <= 1e-5""", "sumstats")
def effect_frequency(v):
    rows = v("sumstats").withColumns({"maf": F.col("mac") / 94, "odds_ratio": F.when(F.col("mac") % 9 > 0, (F.col("mac") % 9).cast("double"))})
    return assoc.effect_frequency(rows, True, 1).select("id", r6("maf"), r6("y"))


@query(f"SELECT id, p FROM (SELECT id, p, row_number() OVER (ORDER BY p, id) AS k, count(*) OVER () AS n FROM sumstats WHERE {VALID}) z WHERE k <= (n + 1) // 2", "sumstats")
def manhattan_thinned(v):
    ok = v("sumstats").filter(assoc.valid_p())
    return assoc.thin_manhattan(ok, ok.count(), 1).select("id", "p")


HTP = """c AS (SELECT vid, y > 500000 AS is_case, g FROM calls JOIN pheno USING (sid) WHERE g IS NOT NULL AND y IS NOT NULL),
h AS (SELECT vid, CAST(sum(g) AS DOUBLE) / (2 * count(*)) AS aaf, count(*) FILTER (WHERE is_case) AS num_cases, count(*) FILTER (WHERE is_case AND g = 0) AS cases_ref, count(*) FILTER (WHERE is_case AND g = 1) AS cases_het, count(*) FILTER (WHERE is_case AND g = 2) AS cases_alt,
  count(*) FILTER (WHERE NOT is_case) AS num_controls, count(*) FILTER (WHERE NOT is_case AND g = 0) AS controls_ref, count(*) FILTER (WHERE NOT is_case AND g = 1) AS controls_het, count(*) FILTER (WHERE NOT is_case AND g = 2) AS controls_alt FROM c GROUP BY vid)"""
_NAMES = ["vid", "aaf", "num_cases", "cases_ref", "cases_het", "cases_alt", "num_controls", "controls_ref", "controls_het", "controls_alt"]


def _htp(v):
    """Genotype counts by status of each variant, as HTP rows hold them."""
    status = v("pheno").filter("y is not null").select("sid", (F.col("y") > 500000).cast("int").alias("case"))
    fit = v("variants").select("vid", F.lit(0.0).alias("beta"), F.lit(1.0).alias("se"), F.lit(1.0).alias("p"))
    named = pooled.htp_rows(v("calls"), v("variants").withColumns({"ref": F.lit("A"), "alt": F.lit("G")}), status, fit, "acctbal")
    return named.select(*[F.col(c).alias(c.lower()) for c in named.columns]).withColumnRenamed("pval", "p")


@query(f"""WITH {HTP}, a AS (SELECT vid, cases_het + 2 * cases_alt + controls_het + 2 * controls_alt AS alt, num_cases + num_controls AS n FROM h), m AS (SELECT vid, CAST(least(alt, 2 * n - alt) AS DOUBLE) AS mac FROM a)
SELECT concat(chrom, ':', pos, ':A:G') AS name, mac, CASE WHEN mac <= 1 THEN '1' WHEN mac <= 5 THEN '2-5' WHEN mac <= 10 THEN '6-10' WHEN mac <= 20 THEN '11-20' ELSE '>20' END AS mac_bin FROM m JOIN variants USING (vid) WHERE mac > 0""", "calls", "pheno", "variants")
def htp_mac_bins(v):
    htp = _htp(v)
    bad = assoc.htp_mac_problems(htp, True)
    return assoc.htp_mac(htp.join(bad, "name", "left_anti"), True).select("name", "mac", "mac_bin")


@query(f"""WITH {HTP}, a AS (SELECT vid, cases_het + 2 * cases_alt + controls_het + 2 * controls_alt AS alt, num_cases + num_controls AS n FROM h)
SELECT concat(chrom, ':', pos, ':A:G') AS name, 'mac' AS problem FROM a JOIN variants USING (vid) WHERE least(alt, 2 * n - alt) <= 0""", "calls", "pheno", "variants")
def htp_mac_faults(v):
    return assoc.htp_mac_problems(_htp(v), True)


@query(f"""WITH {HTP}, b AS (SELECT *, CASE WHEN vid % 7 = 0 THEN num_cases + 1 ELSE num_cases END AS told FROM h JOIN variants USING (vid))
SELECT 'name' AS rule, count(*) FILTER (WHERE vid % 5 = 0) AS violations FROM b UNION ALL SELECT 'score', count(*) FILTER (WHERE vid % 11 = 0) FROM b UNION ALL SELECT 'counts', 0
UNION ALL SELECT 'totals', count(*) FILTER (WHERE vid % 7 = 0) FROM b UNION ALL SELECT 'model', count(*) FILTER (WHERE told > 10 OR num_controls > 12) FROM b UNION ALL SELECT 'trait', count(*) FILTER (WHERE vid % 13 = 0) FROM b
UNION ALL SELECT 'not_in_target', count(*) FILTER (WHERE pos % 2 = 0 OR vid % 5 = 0) FROM b UNION ALL SELECT 'not_in_ld', count(*) FILTER (WHERE pos % 3 = 0 OR vid % 5 = 0) FROM b""", "calls", "pheno", "variants")
def htp_checks(v):
    ids = v("variants").withColumn("id", E.cpra("chrom", "pos", F.lit("A"), F.lit("G")))
    htp = _htp(v).join(ids.select(F.col("id").alias("name"), "vid"), "name")
    spoilt = htp.withColumns({
        "name": F.when(F.col("vid") % 5 == 0, F.concat(F.lit("x"), "name")).otherwise(F.col("name")), "info": F.when(F.col("vid") % 11 == 0, "BETA=1").otherwise(F.col("info")), "num_cases": F.col("num_cases") + (F.col("vid") % 7 == 0).cast("int"),
        "trait": F.when(F.col("vid") % 13 == 0, "other").otherwise(F.col("trait")),
    })
    return quality.check_htp(spoilt, ids.filter("pos % 2 <> 0"), ids.filter("pos % 3 <> 0"), "acctbal", 10, 12)


@query("WITH u AS (SELECT vid FROM variants WHERE vid % 3 <> 0), k AS (SELECT vid, count(g) AS n, count(*) AS m, coalesce(sum(g), 0) AS a FROM calls GROUP BY vid) SELECT vid FROM u JOIN k USING (vid) WHERE n > 0 AND CAST(m - n AS DOUBLE) / m <= 0.05 AND least(CAST(a AS DOUBLE) / (2 * n), 1 - CAST(a AS DOUBLE) / (2 * n)) >= 0.1", "calls", "variants")
def pooled_pass_list(v):
    return pooled.pooled_pass_list(v("variants").filter("vid % 3 <> 0"), v("calls"), 0.05, 0.1)


@query("""WITH k AS (SELECT vid, count(g) AS n, count(*) AS m, coalesce(sum(g), 0) AS a FROM calls GROUP BY vid)
SELECT vid, count(*) AS n_rows FROM calls WHERE vid IN (SELECT vid FROM k JOIN variants USING (vid) WHERE n > 0 AND try_cast(chrom AS INTEGER) <= 11 AND vid % 4 <> 0 AND vid % 4 <> 1 AND least(CAST(a AS DOUBLE) / (2 * n), 1 - CAST(a AS DOUBLE) / (2 * n)) >= 0.05 AND CAST(m - n AS DOUBLE) / m <= 0.05) GROUP BY vid""", "calls", "variants")
def variant_qc_scoped(v):
    alleles = v("variants").withColumns({"ref": F.when(F.col("vid") % 4 == 0, "AT").otherwise("A"), "alt": F.when(F.col("vid") % 4 == 1, "C,G").otherwise("G")})
    out = genotype.variant_qc(v("calls"), 0.05, 0.05, v=alleles, snps_only=True, chroms=[str(c) for c in range(1, 12)], max_alleles=2)
    return out.groupBy("vid").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT vid AS id, 'count' AS problem FROM variants WHERE vid % 17 = 0 UNION ALL SELECT vid, 'repeated' FROM variants WHERE vid % 19 = 0", "variants")
def count_faults(v):
    rows = v("variants").select(F.col("vid").alias("id"), F.when(F.col("vid") % 34 == 0, -1).when(F.col("vid") % 17 == 0, None).otherwise(3).alias("hom_ref"), F.lit(2).alias("het"), F.lit(1).alias("hom_alt"))
    again = rows.filter("id % 19 = 0").withColumn("hom_ref", F.lit(1))
    return genotype.bad_counts(rows.unionByName(again))


@query("SELECT sid FROM pheno WHERE y <= 500000 AND sid % 3 = 0", "pheno")
def hwe_controls(v):
    status = v("pheno").select("sid", (F.col("y") > 500000).cast("int").alias("y"))
    return genotype.hwe_samples(status, v("pheno").filter("sid % 3 = 0"), True)


@query("SELECT sid, count(*) FILTER (WHERE g IS NULL) AS missing, count(*) AS n_rows FROM calls WHERE sid IN (SELECT sid FROM calls GROUP BY sid HAVING CAST(count(*) FILTER (WHERE g IS NULL) AS DOUBLE) / count(*) <= 0.02) GROUP BY sid", "calls")
def sample_qc(v):
    return genotype.sample_qc(v("calls"), 0.02).groupBy("sid").agg(F.count_if(F.col("g").isNull()).alias("missing"), F.count(F.lit(1)).alias("n_rows"))


@query("""WITH k AS (SELECT x.sid AS a, y.sid AS b, count(*) FILTER (WHERE x.g = 1 AND y.g = 1) AS hethet, count(*) FILTER (WHERE abs(x.g - y.g) = 2) AS ibs0, count(*) FILTER (WHERE x.g = 1) AS het_a, count(*) FILTER (WHERE y.g = 1) AS het_b
FROM calls x JOIN calls y ON x.vid = y.vid AND x.sid < y.sid WHERE x.g IS NOT NULL AND y.g IS NOT NULL GROUP BY 1, 2),
r AS (SELECT a, b FROM k WHERE least(het_a, het_b) > 0 AND (hethet - 2 * ibs0) / CAST(2 * least(het_a, het_b) AS DOUBLE) + 0.5 - (het_a + het_b) / CAST(4 * least(het_a, het_b) AS DOUBLE) > 0.2),
e AS (SELECT a, b FROM r UNION SELECT b, a FROM r), w AS (WITH RECURSIVE w(sid, other) AS (SELECT DISTINCT a, a FROM e UNION SELECT w.sid, e.b FROM w JOIN e ON e.a = w.other) SELECT * FROM w)
SELECT sid, min(other) AS family FROM w GROUP BY sid""", "calls")
def related_families(v):
    return genotype.families(genotype.kinship_pairs(v("tiles"), 0.2))


# ------------------------------------------------------------ checks


@query("SELECT CASE WHEN count(*) < 100 THEN 'fail' WHEN count(*) < 5000 THEN 'warn' ELSE 'pass' END AS status, count(*) AS n FROM variants", "variants")
def overlap_gate(v):
    return quality.overlap_gate(v("variants"), 100, 5000)


@query("""WITH d AS (SELECT sid, CASE WHEN sid % 7 = 0 THEN NULL ELSE pc1 END AS pc1, CASE WHEN sid % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE pc2 END AS pc2, pc3 FROM pcs)
SELECT sid, CASE WHEN pc1 IS NULL THEN 'missing_or_nonfinite_pc1' WHEN isnan(pc2) THEN 'missing_or_nonfinite_pc2' END AS reason FROM d WHERE pc1 IS NULL OR isnan(pc2)""", "pcs")
def invalid_pcs(v):
    spoilt = v("pcs").withColumns({"pc1": F.when(F.col("sid") % 7 != 0, F.col("pc1")), "pc2": F.when(F.col("sid") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("pc2"))})
    return ancestry.validate_pcs(spoilt, ["pc1", "pc2", "pc3"])[1].select("sid", "reason")


@query("""WITH t AS (SELECT CASE n_nationkey % 6 WHEN 0 THEN concat(n_name, ' ') WHEN 1 THEN '' WHEN 2 THEN concat('-', n_name) ELSE n_name END AS trait, CASE WHEN n_nationkey % 6 <> 3 THEN '1' END AS c, CASE WHEN n_nationkey % 6 = 4 THEN '1' ELSE '0' END AS k FROM nation),
p AS (SELECT trait, CASE WHEN trait = '' THEN 'blank' WHEN trait <> trim(trait) THEN 'space' WHEN NOT regexp_full_match(trait, '[A-Za-z0-9][A-Za-z0-9._-]*') THEN 'name' WHEN c IS NULL THEN 'half_set' WHEN c = k THEN 'equal_codes' END AS problem FROM t)
SELECT trait, problem FROM p WHERE problem IS NOT NULL UNION ALL SELECT trait, 'repeated' FROM t GROUP BY trait HAVING count(*) > 1""")
def trait_registry(v):
    key = F.col("n_nationkey") % 6
    traits = v("nation").select(
        F.when(key == 0, F.concat("n_name", F.lit(" "))).when(key == 1, "").when(key == 2, F.concat(F.lit("-"), "n_name")).otherwise(F.col("n_name")).alias("trait"), F.when(key != 3, "1").alias("case"), F.when(key == 4, "1").otherwise("0").alias("control"),
    )
    return quality.check_traits(traits)


@query("SELECT case_trait AS value, count(*) AS n FROM samples WHERE case_trait = '0' GROUP BY 1", "samples")
def odd_trait_values(v):
    return quality.odd_trait_values(v("samples"), "case_trait", "1", "2")


@query("SELECT 'sex' AS \"column\", count(*) FILTER (WHERE sex = '2') AS violations FROM samples UNION ALL SELECT 'fid', count(*) FROM samples UNION ALL SELECT 'age', 0", "samples")
def domain_checks(v):
    return quality.check_domains(v("samples"), ("0", "1"), ("fid", "age"))


@query("SELECT 'iid' AS \"column\", concat('[', iid, ']') AS value, 1 AS n FROM samples WHERE age > 70", "samples")
def array_ids(v):
    spoilt = v("samples").withColumn("iid", F.when(F.col("age") > 70, F.concat(F.lit("["), "iid", F.lit("]"))).otherwise(F.col("iid")))
    return quality.check_ids(spoilt, "fid", "iid")


@query("SELECT p_name AS path, 'green' AS pattern FROM part WHERE p_name LIKE '%green%' UNION ALL SELECT p_name, '^b' FROM part WHERE p_name LIKE 'b%'")
def banned_artifacts(v):
    return quality.check_artifacts(v("part").select(F.col("p_name").alias("path")), ["green", "^b"])


@query("""WITH s AS (SELECT n_nationkey AS k, concat('g', n_nationkey) AS group_id, n_name AS trait, n_nationkey % 5 = 0 AS skipped, CASE WHEN n_nationkey % 10 = 0 THEN 'small' ELSE '' END AS reason FROM nation),
c AS (SELECT concat('g', c_nationkey) AS group_id, count(*) AS kept FROM customer WHERE c_nationkey % 10 <> 0 GROUP BY 1), j AS (SELECT s.*, coalesce(kept, 0) AS kept, coalesce(kept, 0) + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS model_n FROM s LEFT JOIN c USING (group_id))
SELECT group_id, 'reason' AS problem FROM j WHERE skipped <> (reason <> '') UNION ALL SELECT group_id, 'skipped_with_samples' FROM j WHERE skipped AND kept > 0 UNION ALL SELECT group_id, 'active_without_samples' FROM j WHERE NOT skipped AND kept < 1
UNION ALL SELECT group_id, 'model_n' FROM j WHERE model_n <> kept UNION ALL SELECT group_id, 'usable_n' FROM j WHERE NOT skipped AND model_n <> kept UNION ALL SELECT group_id, 'cases' FROM j WHERE NOT skipped AND k % 2 = 0 AND kept % 2 <> 0
UNION ALL SELECT group_id, 'repeated' FROM j WHERE k = 3 UNION ALL SELECT group_id, 'unexpected' FROM j WHERE k % 6 = 4 UNION ALL SELECT 'gx', 'missing'""")
def group_status(v):
    k = F.col("n_nationkey")
    kept = v("customer").filter("c_nationkey % 10 <> 0").select(F.concat(F.lit("g"), "c_nationkey").alias("group_id"), F.col("c_custkey").alias("sid"))
    n = v("nation").select(k, F.concat(F.lit("g"), k).alias("group_id"), F.col("n_name").alias("trait"), (k % 5 == 0).alias("skipped"), F.when(k % 10 == 0, "small").otherwise("").alias("reason"), F.when(k % 2 == 0, "bt").otherwise("qt").alias("kind"))
    n = n.join(kept.groupBy("group_id").agg(F.count(F.lit(1)).alias("c")), "group_id", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    model = F.col("c") + (k % 7 == 0).cast("int")
    status = n.select("n_nationkey", "group_id", "trait", "skipped", "reason", "kind", model.alias("model_n"), model.alias("usable_n"), F.floor(F.col("c") / 2).alias("cases"), F.floor(F.col("c") / 2).alias("controls"))
    # a repeated group: its second row differs in nothing that the rules judge anew
    twice = status.filter("n_nationkey = 3").withColumns({"skipped": F.lit(False), "reason": F.lit("")})
    expected = status.filter("n_nationkey % 6 <> 4").select("group_id", "trait")
    expected = expected.unionByName(expected.limit(1).select(F.lit("gx").alias("group_id"), F.lit("x").alias("trait")))
    found = quality.check_status(status.unionByName(twice), kept, expected)
    return found.distinct()


@query("SELECT r_name AS role, 'repeated' AS problem FROM region WHERE r_name = 'ASIA' UNION ALL SELECT r_name, 'no_release' FROM region WHERE r_name = 'EUROPE' UNION ALL SELECT 'MOON', 'missing'")
def release_roles(v):
    r = v("region").select(F.col("r_name").alias("role"), F.when(F.col("r_name") == "EUROPE", " ").otherwise(F.col("r_name")).alias("release"))
    return quality.check_roles(r.unionByName(r.filter("role = 'ASIA'")), ["AFRICA", "ASIA", "EUROPE", "MOON"])


@query("SELECT fid, iid, true AS in_first, false AS in_second, age > 50 AS in_third FROM samples WHERE age > 30 AND age <= 60 UNION ALL SELECT fid, iid, true, true, false FROM samples WHERE age <= 30 OR age > 60 AND false", "samples")
def sample_sets(v):
    s = v("samples")
    return quality.same_samples(first=s, second=s.filter("age <= 30 or age > 60"), third=s.filter("age > 50"))


@query("""WITH a AS (SELECT DISTINCT id, chrom, pos, least(ref, alt) AS lo, greatest(ref, alt) AS hi FROM variants_ref), b AS (SELECT DISTINCT id, chrom, pos, least(ref, alt) AS lo, greatest(ref, alt) AS hi FROM variants_study)
SELECT 'left' AS side, x.* FROM (FROM a EXCEPT FROM b) x UNION ALL SELECT 'right', y.* FROM (FROM b EXCEPT FROM a) y""", "variants_ref", "variants_study")
def same_variants(v):
    return quality.same_variants(v("variants_ref"), v("variants_study"))


@query("""SELECT 'label_sizes' AS rule, count(*) FILTER (WHERE n <> 40) AS violations FROM (SELECT chrom, count(*) AS n FROM variants WHERE vid % 3 <> 0 GROUP BY chrom) x UNION ALL SELECT 'unique_ids', 0 UNION ALL SELECT 'unique_loci', 0
UNION ALL SELECT 'removal', count(*) FILTER (WHERE (vid % 3 <> 0) <> (vid % 4 <> 0)) FROM variants""", "variants")
def panel_checks(v):
    given = v("variants").select(F.col("vid").cast("string").alias("id"), "chrom", "pos", F.col("chrom").alias("label"))
    return quality.check_panel(given.filter("cast(id as long) % 3 <> 0"), given, given.filter("cast(id as long) % 4 = 0"), {str(c): 40 for c in range(1, 23)})


@query("""WITH q AS (SELECT fid, iid FROM samples WHERE age >= 40 UNION ALL SELECT iid, iid FROM samples WHERE age >= 40 AND age < 45) SELECT DISTINCT q.fid, q.iid FROM q JOIN samples s ON s.iid = q.iid AND s.age < 43""", "samples")
def merged_overlap(v):
    study = v("samples").filter("age >= 40").select("fid", "iid")
    study = study.unionByName(v("samples").filter("age >= 40 and age < 45").select(F.col("iid").alias("fid"), "iid"))
    return samples.in_both(v("samples").filter("age < 43"), study.distinct())


@query("SELECT fid, iid, 'reference' AS sample_set, ancestry AS label FROM samples WHERE age < 40 UNION ALL SELECT fid, iid, 'study', '-' FROM samples WHERE age >= 40", "samples")
def merged_cohorts(v):
    return samples.merge_cohorts(v("samples").filter("age < 40"), v("samples").filter("age >= 40"), v("samples").select("fid", "iid", F.col("ancestry").alias("label")))


@query("SELECT a.fid, a.iid, age FROM samples s JOIN aliases a USING (iid)", "samples", "aliases")
def canonical_ids(v):
    known = v("samples").join(v("aliases").select("iid"), "iid", "left_semi").select("fid", "iid", "age")
    return samples.canonicalize_ids(known, v("aliases"))


@query("SELECT a.fid, a.iid, s.age, s.sex FROM aliases a JOIN samples s USING (iid)", "samples", "aliases")
def sample_metadata(v):
    meta = v("samples").select("fid", "iid", "age", "sex")
    return samples.attach_metadata(v("aliases"), meta.unionByName(meta.withColumn("age", F.col("age") + 1)), ["age"])


@query("SELECT alias, iid, n FROM (SELECT unnest(list_distinct([fid, iid, '0'])) AS alias, iid FROM (SELECT fid, iid FROM samples UNION ALL SELECT concat(fid, 'x'), iid FROM samples WHERE age > 60) u) z JOIN (SELECT 2 AS n) t ON true GROUP BY alias, iid, n HAVING count(*) > 1", "samples")
def alias_conflicts(v):
    twice = v("samples").filter("age > 60").select(F.concat("fid", F.lit("x")).alias("fid"), "iid")
    return samples.ambiguous_aliases(v("samples").select("fid", "iid").unionByName(twice)).withColumn("n", F.col("n").cast("int"))


@query("SELECT s.fid, s.iid, s.age, a.bonus FROM samples s LEFT JOIN (SELECT iid, length(fid) AS bonus FROM aliases) a USING (iid)", "samples", "aliases")
def covariates_attached(v):
    return samples.attach_covariates(v("samples").select("fid", "iid", "age"), v("aliases").withColumn("bonus", F.length("fid")), ["age", "bonus"])


@query("""SELECT fid, iid, CASE WHEN sex = '1' THEN ancestry ELSE 'UNKNOWN' END AS ancestry, CASE WHEN sex = '1' THEN 'assigned' WHEN age > 50 THEN 'far' ELSE 'missing_popmad_assignment' END AS reason FROM samples""", "samples")
def ancestry_attached(v):
    s = v("samples")
    return samples.attach_ancestry(s.select("fid", "iid"), s.filter("sex = '1'"), s.filter("sex <> '1' and age > 50").withColumn("reason", F.lit("far")))


@query("SELECT fid, iid FROM samples WHERE iid NOT IN (SELECT iid FROM aliases)", "samples", "aliases")
def samples_without_alias(v):
    return samples.missing_from(v("samples"), v("aliases"), ["iid"]).select("fid", "iid")


@query("SELECT fid, iid FROM samples WHERE quant_trait <> '-9' AND case_trait <> 'NA'", "samples")
def complete_cases(v):
    coded = v("samples").withColumn("y", samples.encode_trait("case_trait", "1", "0")[0])
    return samples.complete_cases(coded.withColumn("q", E.nullify("quant_trait", samples.MISSING)), ["age", "q"], "y").select("fid", "iid")


@query("""SELECT sid, CASE WHEN mod(sid, 7) = 3 THEN 'missing_popmad' WHEN CAST(population AS VARCHAR) = CAST(super_population AS VARCHAR) THEN 'match' ELSE 'discordant' END AS status FROM pcs""", "pcs")
def assignments_compared(v):
    study = v("pcs").select("sid", F.col("population").cast("string").alias("top"))
    return ancestry.compare_assignments(study, v("pcs").filter("sid % 7 <> 3").select("sid", F.col("super_population").alias("ancestry"))).select("sid", "status")


Q = "q AS (SELECT sid, 'A' AS label, CAST(sid % 8 AS DOUBLE) / 8 AS q, population FROM pcs UNION ALL SELECT sid, 'B', 1 - CAST(sid % 8 AS DOUBLE) / 8, population FROM pcs)"


def _q(v):
    a = (F.col("sid") % 8) / 8
    return v("pcs").select("sid", F.inline(F.array(F.struct(F.lit("A").alias("label"), a.alias("q")), F.struct(F.lit("B").alias("label"), (1 - a).alias("q")))))


@query(f"""WITH {Q}, t AS (SELECT sid, CASE WHEN sid % 8 >= 4 THEN 'A' ELSE 'B' END AS top, CASE WHEN sid % 5 = 0 THEN NULL WHEN sid % 3 = 0 THEN 'A' ELSE 'B' END AS given FROM pcs), s AS (SELECT count(*) AS n, count(*) FILTER (WHERE top = given) AS m, count(*) FILTER (WHERE top <> given) AS d, count(*) FILTER (WHERE given IS NULL) AS x FROM t)
SELECT 'samples' AS metric, CAST(n AS VARCHAR) AS value FROM s UNION ALL SELECT 'matches', CAST(m AS VARCHAR) FROM s UNION ALL SELECT 'discordant', CAST(d AS VARCHAR) FROM s UNION ALL SELECT 'missing', CAST(x AS VARCHAR) FROM s UNION ALL SELECT 'match_rate', printf('%.6f', CAST(m AS DOUBLE) / (m + d)) FROM s
UNION ALL SELECT concat('mean_proportion_', label), printf('%.6f', avg(q)) FROM q GROUP BY label UNION ALL SELECT concat('top_', top), CAST(count(*) AS VARCHAR) FROM t GROUP BY top""", "pcs")
def proportion_summary(v):
    top = ancestry.top_component(_q(v)).select("sid", F.col("label").alias("top"))
    given = v("pcs").filter("sid % 5 <> 0").select("sid", F.when(F.col("sid") % 3 == 0, "A").otherwise("B").alias("ancestry"))
    return ancestry.proportion_summary(_q(v), ancestry.compare_assignments(top, given))


@query(f"WITH {Q} SELECT sid, CASE WHEN sid % 8 >= 4 THEN 'A' ELSE 'B' END AS label, round(greatest(CAST(sid % 8 AS DOUBLE) / 8, 1 - CAST(sid % 8 AS DOUBLE) / 8), 6) AS q FROM pcs", "pcs")
def top_components(v):
    return ancestry.top_component(_q(v)).select("sid", "label", r6("q"))


@query(f"""WITH {Q}, m AS (SELECT population AS label, label AS component, avg(q) AS m FROM q GROUP BY 1, 2), k AS (SELECT label, component, row_number() OVER (PARTITION BY label ORDER BY m DESC, component) AS k FROM m), c AS (SELECT label, component FROM k WHERE k = 1)
SELECT component, (SELECT count(*) FROM c WHERE c.component = x.component) AS labels FROM (SELECT 'A' AS component UNION ALL SELECT 'B') x WHERE (SELECT count(*) FROM c WHERE c.component = x.component) <> 1""", "pcs")
def components_ambiguous(v):
    q = _q(v).withColumnRenamed("label", "component")
    found = ancestry.label_components(q, v("pcs").select("sid", F.col("population").alias("label")))
    return ancestry.ambiguous_components(found, q)


@query("""WITH a AS (SELECT ancestry, count(*) AS n FROM samples WHERE age > 30 GROUP BY 1), l AS (SELECT DISTINCT ancestry FROM samples UNION ALL SELECT 'A9')
SELECT ancestry, coalesce(n, 0) AS n, coalesce(n, 0) >= 25 AS active, CASE WHEN n IS NULL THEN 'no_assigned_samples' WHEN n < 25 THEN 'below_min_stratum_n' ELSE '' END AS reason FROM l LEFT JOIN a USING (ancestry)""", "samples")
def active_strata(v):
    labels = v("samples").select("ancestry").distinct()
    return ancestry.active_strata(v("samples").filter("age > 30"), labels.unionByName(labels.limit(1).select(F.lit("A9").alias("ancestry"))), 25)


@query("""WITH s AS (SELECT ancestry, ancestry IN ('A0', 'A1', 'A2') AS active FROM samples GROUP BY 1), x AS (SELECT ancestry, case_trait, CASE WHEN quant_trait <> '-9' THEN 1 END AS q FROM samples),
b AS (SELECT ancestry, count(*) FILTER (WHERE case_trait IN ('0', '1')) AS n, count(*) FILTER (WHERE case_trait = '1') AS cases, count(*) FILTER (WHERE case_trait = '0') AS controls, count(q) AS nq FROM x GROUP BY 1)
SELECT 'case' AS trait, ancestry, n, cases, controls, active, CASE WHEN active THEN '' ELSE 'below' END AS excluded_reason, n < 30 OR cases < 12 OR controls < 12 AS underpowered FROM s JOIN b USING (ancestry)
UNION ALL SELECT 'quant', ancestry, nq, NULL, NULL, active, CASE WHEN active THEN '' ELSE 'below' END, nq < 30 FROM s JOIN b USING (ancestry)
UNION ALL SELECT 'ALL', 'UNASSIGNED', count(*), NULL, NULL, false, 'not_in_active_strata', count(*) > 0 FROM samples WHERE ancestry NOT IN ('A0', 'A1', 'A2')""", "samples")
def trait_strata(v):
    strata = v("samples").select("ancestry").distinct().withColumn("active", F.col("ancestry").isin("A0", "A1", "A2")).withColumn("reason", F.when(F.col("active"), "").otherwise("below"))
    return ancestry.trait_strata(v("samples"), {"case": samples.encode_trait("case_trait", "1", "0")[0]}, {"quant": samples.quantitative("quant_trait")}, strata, 30, 12, 12)


@query("SELECT count(*) AS total, count(*) FILTER (WHERE age > 40) AS unassigned, round(CAST(count(*) FILTER (WHERE age > 40) AS DOUBLE) / count(*), 6) AS fraction, CASE WHEN CAST(count(*) FILTER (WHERE age > 40) AS DOUBLE) / count(*) > 0.25 THEN 'error' ELSE 'ok' END AS status FROM samples", "samples")
def unassigned_share(v):
    return ancestry.unassigned(v("samples").withColumn("reason", F.when(F.col("age") > 40, "far")), 0.25).withColumn("fraction", F.round("fraction", 6))


@query("SELECT 'PC1' AS pc, count(*) AS n, round(corr(pc1, pc1 + 0.5 * pc2), 6) AS r, abs(corr(pc1, pc1 + 0.5 * pc2)) >= 0.95 AS passed FROM pcs UNION ALL SELECT 'PC2', count(*), round(corr(pc2, 0 - pc2), 6), true FROM pcs", "pcs")
def projection_check(v):
    fitted = v("pcs").select("sid", F.inline(F.array(F.struct(F.lit("PC1").alias("pc"), F.col("pc1").alias("score")), F.struct(F.lit("PC2").alias("pc"), F.col("pc2").alias("score")))))
    other = v("pcs").select("sid", F.inline(F.array(F.struct(F.lit("PC1").alias("pc"), (F.col("pc1") + 0.5 * F.col("pc2")).alias("score")), F.struct(F.lit("PC2").alias("pc"), (-F.col("pc2")).alias("score")))))
    return ancestry.check_projection(fitted, other).withColumn("r", F.round("r", 6))


@query("SELECT sid, sid % 2 AS stratum, pc1, pc2, CASE WHEN sid % 2 = 0 THEN pc3 END AS pc3 FROM pcs", "pcs")
def combined_pcs(v):
    even, odd = v("pcs").filter("sid % 2 = 0").select("sid", "pc1", "pc2", "pc3"), v("pcs").filter("sid % 2 = 1").select("sid", "pc1", "pc2")
    return pooled.combine_pcs({"0": even, "1": odd}).withColumn("stratum", F.col("stratum").cast("long"))


@query("SELECT CASE WHEN age > 50 THEN 'old' ELSE 'young' END AS stratum, fid, iid FROM samples", "samples")
def bound_strata(v):
    s = v("samples")
    return summaries.bind_strata({"old": s.filter("age > 50"), "young": s.filter("age <= 50")}, ["fid", "iid"])


MODEL = """SELECT 'case' AS trait, 'bt' AS kind, count(*) AS pan_n, count(*) AS complete_n, count(*) FILTER (WHERE case_trait <> 'NA') AS usable_n, count(*) FILTER (WHERE case_trait = '1') AS cases, count(*) FILTER (WHERE case_trait = '0') AS controls FROM samples
UNION ALL SELECT 'quant', 'qt', count(*), count(*), count(*) FILTER (WHERE quant_trait <> '-9'), NULL, NULL FROM samples"""


def _models(v):
    s = v("samples").withColumn("sid", F.col("iid"))
    case = summaries.trait_model_summary(s, "case", True, ["age"], samples.encode_trait("case_trait", "1", "0")[0], 10_000)
    return summaries.consolidate_status(case, summaries.trait_model_summary(s, "quant", False, ["age"], samples.quantitative("quant_trait"), 10))


@query(f"""WITH m AS ({MODEL}), r AS (SELECT *, concat_ws(';', CASE WHEN kind = 'bt' AND usable_n < 10000 THEN concat('n=', usable_n, '<min_n=10000') END, CASE WHEN kind = 'qt' AND usable_n < 10 THEN concat('n=', usable_n, '<min_n=10') END, CASE WHEN cases < 50 THEN concat('cases=', cases, '<min_cases=50') END, CASE WHEN controls < 50 THEN concat('controls=', controls, '<min_controls=50') END) AS reason FROM m)
SELECT trait, kind, pan_n, complete_n, usable_n, cases, controls, CASE WHEN reason = '' THEN usable_n ELSE 0 END AS model_n, reason <> '' AS skipped, reason, concat(kind, '__', trait) AS group_id, reason = '' AS eligible FROM r""", "samples")
def model_summaries(v):
    return _models(v).drop("keep_hash")


@query("""WITH k AS (SELECT count(*) AS a, count(*) FILTER (WHERE age > 25) AS b, count(*) FILTER (WHERE age > 35) AS c, count(*) FILTER (WHERE age > 35 AND sex = '1') AS d FROM samples)
SELECT 'manifest_samples' AS metric, CAST(a AS VARCHAR) AS value FROM k UNION ALL SELECT 'sex_checked_samples', CAST(b AS VARCHAR) FROM k UNION ALL SELECT 'pan_samples', CAST(c AS VARCHAR) FROM k UNION ALL SELECT 'assigned', CAST(d AS VARCHAR) FROM k UNION ALL SELECT 'unknown', CAST(c - d AS VARCHAR) FROM k""", "samples")
def pan_summary(v):
    s = v("samples")
    return summaries.pan_summary(s, s.filter("age > 25"), s.filter("age > 35").withColumn("ancestry", F.when(F.col("sex") == "1", F.col("ancestry"))))


@query("""WITH k AS (SELECT count(*) AS n, count(*) FILTER (WHERE sid % 6 = 0) AS bad FROM pheno), m AS (SELECT count(*) FILTER (WHERE chrom = '22') AS x, count(*) FILTER (WHERE chrom = '21') AS y FROM variants)
SELECT 'checked' AS metric, CAST(n AS VARCHAR) AS value FROM k UNION ALL SELECT 'problems', CAST(bad AS VARCHAR) FROM k UNION ALL SELECT 'kept', CAST(n - bad AS VARCHAR) FROM k UNION ALL SELECT 'removed', CAST(bad AS VARCHAR) FROM k UNION ALL SELECT 'action', 'exclude' UNION ALL SELECT 'x_markers', CAST(x AS VARCHAR) FROM m UNION ALL SELECT 'y_markers', CAST(y AS VARCHAR) FROM m""", "pheno", "variants")
def sex_summary(v):
    markers = v("variants").withColumn("chrom", F.when(F.col("chrom") == "22", "X").when(F.col("chrom") == "21", "Y").otherwise(F.col("chrom")))
    return summaries.sex_check_summary(v("pheno").withColumn("status", F.when(F.col("sid") % 6 == 0, "manifest_genetic_mismatch").otherwise("ok")), "exclude", markers)


GENES = "genes AS (SELECT concat(chrom, '_', CAST(pos // 20000 AS VARCHAR)) AS gene, chrom, min(pos) AS start, max(pos) - 100 AS \"end\" FROM variants GROUP BY 1, 2)"


@query(f"""WITH {GENES}, i AS (SELECT concat(chrom, '_', CAST(pos // 20000 AS VARCHAR)) AS gene, vid AS id, chrom, pos FROM variants WHERE vid % 5 <> 0 AND pos // 20000 % 7 <> 0),
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE pos BETWEEN start AND "end") AS inside FROM i JOIN genes USING (gene)), t AS (SELECT count(*) AS t, (SELECT count(DISTINCT id) FROM i) AS k FROM variants), g AS (SELECT count(*) AS g, (SELECT count(DISTINCT gene) FROM i) AS h FROM genes)
SELECT metric, value FROM (SELECT CAST(t AS VARCHAR) AS targets, CAST(k AS VARCHAR) AS indexed, CAST(t - k AS VARCHAR) AS not_indexed, printf('%.6f', 100.0::DOUBLE * k / t) AS target_coverage_pct, CAST(g AS VARCHAR) AS genes, CAST(h AS VARCHAR) AS indexed_genes, CAST(g - h AS VARCHAR) AS genes_without_variants,
  printf('%.6f', 100.0::DOUBLE * h / g) AS gene_coverage_pct, CAST(n AS VARCHAR) AS assignments, CAST(inside AS VARCHAR) AS within, CAST(n - inside AS VARCHAR) AS outside, printf('%.6f', 100.0::DOUBLE * inside / n) AS within_pct FROM a, t, g) w UNPIVOT (value FOR metric IN (targets, indexed, not_indexed, target_coverage_pct, genes, indexed_genes, genes_without_variants, gene_coverage_pct, assignments, within, outside, within_pct))""", "variants")
def ld_coverage(v):
    named = v("variants").withColumns({"gene": F.concat("chrom", F.lit("_"), F.floor(F.col("pos") / 20000).cast("string")), "id": F.col("vid")})
    genes = named.groupBy("gene", "chrom").agg(F.min("pos").alias("start"), (F.max("pos") - 100).alias("end"))
    index = named.filter((F.col("vid") % 5 != 0) & (F.floor(F.col("pos") / 20000) % 7 != 0)).select("gene", "id")
    return summaries.ld_coverage(index, named, genes)


@query(f"""WITH x AS (SELECT id, mac, p, {VALID} AS ok FROM sumstats)
SELECT 'settings' AS section, 'trait' AS key, 'acctbal' AS value UNION ALL
SELECT 'mac_bins', CASE WHEN mac <= 1 THEN '1' WHEN mac <= 5 THEN '2-5' WHEN mac <= 10 THEN '6-10' WHEN mac <= 20 THEN '11-20' ELSE '>20' END, CAST(count(*) AS VARCHAR) FROM x WHERE ok GROUP BY 2 UNION ALL
SELECT 'checks', 'mac_bins', concat(count(*) FILTER (WHERE ok), '|', count(*) FILTER (WHERE ok), '|ok') FROM x UNION ALL SELECT 'checks', 'unique_ids', concat(count(DISTINCT id), '|', count(*), '|', CASE WHEN count(DISTINCT id) = count(*) THEN 'ok' ELSE 'differs' END) FROM x UNION ALL
SELECT 'checks', 'minor_alleles', concat(count(*) FILTER (WHERE ok AND mac > 0), '|', count(*) FILTER (WHERE ok), '|', CASE WHEN count(*) FILTER (WHERE ok AND mac > 0) = count(*) FILTER (WHERE ok) THEN 'ok' ELSE 'differs' END) FROM x""", "sumstats")
def rare_report(v):
    return summaries.rare_report(v("sumstats"), {"trait": "acctbal"})


@query("""SELECT 'settings' AS section, 'panel' AS key, 'x' AS value UNION ALL SELECT 'counts', 'shared_variants', CAST(count(*) AS VARCHAR) FROM variants UNION ALL SELECT 'counts', 'pruned_variants', CAST(count(*) FILTER (WHERE vid % 2 = 0) AS VARCHAR) FROM variants
UNION ALL SELECT 'counts', 'exclusions', CAST(count(*) FILTER (WHERE vid % 9 = 0) AS VARCHAR) FROM variants UNION ALL SELECT 'status', 'shared_variants', CASE WHEN count(*) < 150 THEN 'fail' WHEN count(*) < 3000 THEN 'warn' ELSE 'pass' END FROM variants
UNION ALL SELECT 'projection', 'PC1', concat(CASE WHEN abs(corr(pc1, pc2)) >= 0.95 THEN 'pass' ELSE 'fail' END, ' abs(r)=', printf('%.3f', abs(corr(pc1, pc2)))) FROM pcs""", "variants", "pcs")
def ancestry_report(v):
    score = lambda c: v("pcs").select("sid", F.lit("PC1").alias("pc"), F.col(c).alias("score"))
    all_v = v("variants")
    return summaries.ancestry_prep_report(all_v, all_v.filter("vid % 2 = 0"), all_v.filter("vid % 9 = 0"), ancestry.check_projection(score("pc1"), score("pc2")), {"panel": "x"}, 150, 3000)


@query(f"""WITH {Q} SELECT CAST(s AS VARCHAR) AS stratum, metric, value FROM (SELECT sid % 2 AS s, concat('mean_proportion_', label) AS metric, printf('%.6f', avg(q)) AS value FROM q GROUP BY 1, 2) z""", "pcs")
def admixture_report(v):
    parts = {}
    for s in (0, 1):
        q = _q(v).filter(F.col("sid") % 2 == s)
        parts[str(s)] = ancestry.proportion_summary(q, ancestry.compare_assignments(ancestry.top_component(q).select("sid", F.col("label").alias("top")), None)).filter("metric like 'mean%'")
    return summaries.admixture_report(parts)


@query()
def pooled_report(v):
    return summaries.pooled_report(v("sumstats"), {"trait": "acctbal"}, v("sumstats").withColumn("ancestry", F.concat(F.lit("A"), (F.col("row_id") % 3).cast("string"))))


@query()
def pooled_binary_test(v):
    case = v("pheno").withColumn("y", (F.col("y") > 500000).cast("int"))
    return pooled.pooled_binary(v("calls"), v("variants"), case, ["pop"], min_mac=3).select("vid", "n", F.round("chi2", 5).alias("chi2"), "test")


@query()
def ridge_loco(v):
    return ridge.fit_ridge_loco(v("calls"), v("variants"), v("pheno"), ["pop"]).select("sid", "chrom", F.round("pred", 3).alias("pred"))


@query("SELECT p_brand AS sha256, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def repeated_artifacts(v):
    return manifest.repeated_artifacts(v("part").select(F.col("p_brand").alias("sha256")))


@query("SELECT concat('p', p_partkey) AS path, CASE WHEN p_partkey % 3 = 0 THEN 'extra' ELSE 'missing' END AS problem FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 5 <> 0 OR p_partkey % 5 = 0 AND p_partkey % 3 <> 0")
def artifacts_compared(v):
    p = v("part").select("p_partkey", F.concat(F.lit("p"), "p_partkey").alias("path"))
    return manifest.artifact_diff(p.filter("p_partkey % 3 <> 0"), p.filter("p_partkey % 5 <> 0"))


@query("""WITH i AS (SELECT concat('d/', p_partkey) AS path, p_size AS s, p_partkey AS k FROM part)
SELECT path, 'missing' AS problem FROM i WHERE k % 7 = 0 UNION ALL SELECT path, 'extra' FROM i WHERE k % 11 = 0 AND k % 7 <> 0 UNION ALL SELECT path, 'size' FROM i WHERE k % 13 = 0 AND k % 7 <> 0 AND k % 11 <> 0
UNION ALL SELECT path, 'hash' FROM i WHERE k % 17 = 0 AND k % 13 <> 0 AND k % 7 <> 0 AND k % 11 <> 0 UNION ALL SELECT '/a', 'missing' UNION ALL SELECT '/a', 'path'""")
def inventory_checked(v):
    k = F.col("k")
    i = v("part").select(F.col("p_partkey").alias("k"), F.concat(F.lit("d/"), "p_partkey").alias("path"), F.lit("h").alias("sha256"), F.col("p_size").cast("long").alias("size_bytes"))
    declared = i.filter("k % 11 <> 0 or k % 7 = 0").drop("k")
    declared = declared.unionByName(declared.limit(1).withColumn("path", F.lit("/a")))
    actual = i.filter("k % 7 <> 0").withColumns({"size_bytes": F.when(k % 13 == 0, 0).otherwise(F.col("size_bytes")), "sha256": F.when(k % 17 == 0, "x").otherwise(F.col("sha256"))}).drop("k")
    return quality.check_inventory(declared, actual)


@query("""WITH i AS (SELECT chrom, pos AS start, CASE WHEN vid % 10 = 0 THEN pos - 1 WHEN vid % 4 = 0 THEN pos + 100000 ELSE pos + 10 END AS "end" FROM variants),
b AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i)
SELECT chrom, start, "end", CASE WHEN start > "end" THEN 'reversed' ELSE 'overlap' END AS rule FROM b WHERE start > "end" OR start <= before""", "variants")
def interval_checks(v):
    iv = v("variants").select("chrom", F.col("pos").alias("start"), F.when(F.col("vid") % 10 == 0, F.col("pos") - 1).when(F.col("vid") % 4 == 0, F.col("pos") + 100000).otherwise(F.col("pos") + 10).alias("end"))
    return quality.check_intervals(iv)


@query("""WITH m AS (SELECT concat(chrom, ':', pos, ':', ref, ':', alt) AS cpra, * FROM variants_study)
SELECT id, 'id' AS problem FROM m WHERE chrom LIKE 'chr%' AND id = cpra AND false
UNION ALL SELECT id, 'duplicate' FROM m GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, CASE WHEN id <> concat(regexp_replace(chrom, '^chr', ''), ':', pos, ':', ref, ':', alt) THEN 'id' WHEN info = 'PR' THEN 'provisional' END FROM m WHERE id <> concat(regexp_replace(chrom, '^chr', ''), ':', pos, ':', ref, ':', alt) OR info = 'PR'""", "variants_study")
def cpra_checks(v):
    return quality.check_cpra(v("variants_study"))


@query("""WITH m AS (SELECT CASE WHEN p_partkey % 9 = 0 THEN 'same' ELSE concat('h', p_partkey // 2) END AS h, 1 + p_partkey % 22 AS c, p_partkey AS pos FROM part)
SELECT h AS harmonized_id, CASE WHEN count(DISTINCT concat(c, ':', pos)) > 1 THEN 'multiple loci' ELSE 'multiple variants at locus' END AS problem FROM m GROUP BY h HAVING count(*) > 1""")
def id_integrity(v):
    k = F.col("p_partkey")
    m = v("part").select(F.when(k % 9 == 0, "same").otherwise(F.concat(F.lit("h"), F.floor(k / 2).cast("string"))).alias("harmonized_id"), (1 + k % 22).cast("string").alias("chrom"), k.cast("long").alias("pos"))
    return variants.check_id_integrity(m)


@query("SELECT concat('h', p_partkey % 10) AS h, count(DISTINCT p_size) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_size) > 1")
def functional_checks(v):
    return quality.not_functional(v("part").select(F.concat(F.lit("h"), F.col("p_partkey") % 10).alias("h"), "p_size"), "h", "p_size")


@query()
def ridge_loco_binary(v):
    case = v("pheno").filter("y is not null").withColumn("y", (F.col("y") > 500000).cast("int"))
    return ridge.fit_ridge_loco(v("calls"), v("variants"), case, ["pop"], binary=True).select("sid", "chrom", F.round("pred", 3).alias("pred"))
