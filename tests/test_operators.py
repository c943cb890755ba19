"""Operators against small cases worked out by hand or by brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators import ancestry, assoc, genotype, pooled, quality, reports, samples, subspace, variants


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


@pytest.mark.parametrize("given, want", [("chr23", "X"), ("CHRx", "X"), ("24", "Y"), ("25", "XY"), (" 7", "7"), ("NA", None), ("0", None)])
def test_chromosome(spark, given, want):
    assert one(spark, E.normalize_chrom("c"), c=given) == want


@pytest.mark.parametrize("given, want", [("1e-3", 0.001), (".5", 0.5), ("1e999", None), ("x", None), ("NaN", None), ("1.", 1.0)])
def test_finite(spark, given, want):
    assert one(spark, E.finite("c"), c=given) == want


def test_info(spark):
    assert one(spark, E.info_flag("c", "PR"), c="AF=1;PR") is True
    assert one(spark, E.info_value("c", "R2"), c="AF=1;r2=0.5;R2=0.7") == "0.5"
    assert one(spark, E.safe_name("c"), c="--a b//c") == "--a_b_c"


def test_normal_quantile(spark):
    for p, z in ((0.975, 1.959963984540054), (0.5, 0.0), (1e-10, -6.361340902404056), (1e-20, -9.262340089798408)):
        assert math.isclose(one(spark, E.probit("c"), c=p), z, abs_tol=1e-12, rel_tol=1e-12)


def test_alias_match_prefers_family_id(spark):
    q = spark.createDataFrame([("F1", "I1"), ("F2", "I2"), ("F9", "I9")], "fid string, iid string")
    t = spark.createDataFrame([("F1", "I1"), ("0", "I2")], "fid string, iid string")
    got = {r.iid: r.target_fid for r in samples.match_samples(q, t).collect()}
    assert got == {"I1": "F1", "I2": "0", "I9": None}
    twice = spark.createDataFrame([("F1", "I1"), ("F2", "I1")], "fid string, iid string")
    assert {(r.alias, r.n) for r in samples.ambiguous_aliases(twice).collect()} == {("I1", 2), ("0", 2)}


def test_harmonization_rules(spark):
    names = "chrom string, pos long, id string, ref string, alt string, info string"
    ref = spark.createDataFrame([("1", 100, "rs100", "A", "G", "."), ("1", 200, "1:200:A:T", "A", "T", "."), ("1", 300, "x", "A", "G", "."), ("1", 400, "d1", "C", "A", "."), ("1", 400, "d2", "A", "C", "."), ("1", 500, "y", "A", "G", "."), ("1", 600, "z", "A", "G", "PR")], names)
    study = spark.createDataFrame([("chr1", 100, "rs7", "A", "G", "."), ("1", 200, "s", "T", "A", "."), ("1", 300, "s3", "G", "A", "."), ("1", 500, "s5", "A", "C", "."), ("1", 600, "s6", "G", "A", "PR")], names)
    out = variants.harmonize_variants(ref, study)
    (kept,) = out.mapping.collect()
    assert (kept.harmonized_id, kept.differing_rsid, kept.orientation) == ("rs100", True, "same")
    assert {(r.pos, r.reason, r.excluded_side) for r in out.mismatches.collect()} == {
        (200, "palindromic_snp_excluded", "both"), (300, "pvar_known_ref_disagreement", "both"), (400, "duplicate_locus_allele_key_reference", "reference"),
        (500, "allele_mismatch", "both"), (600, "no_pvar_known_ref_for_cpra", "both"),
    }


def test_info_filter_takes_the_first_metric_with_values(spark):
    v = spark.createDataFrame([("rs1", "R2=0.5", "NA"), ("rs2", "R2=0.1", "0.9"), ("rs3", ".", "0.5")], "id string, info string, R2 string")
    out = variants.info_filter(v, 0.8, ("R2",))
    assert out.metric == "column:R2" and {r.id for r in out.passed.collect()} == {"rs1", "rs2"}
    out = variants.info_filter(v, 0.3)
    assert out.metric == "INFO keys" and {r.id for r in out.excluded.collect()} == {"rs2"}


def test_binned_range_join_equals_broadcast(spark):
    v = spark.range(0, 200).select(F.lit("1").alias("chrom"), (F.col("id") * 997).alias("pos"))
    iv = spark.createDataFrame([("1", 5000, 60000), ("1", 59000, 61000), ("1", 150000, 150000)], "chrom string, start long, end long")
    a, b = variants.in_intervals(v, iv, 3), variants.in_intervals(v, iv, 10**6)
    assert sorted(r.pos for r in a.collect()) == sorted(r.pos for r in b.collect()) != []


def test_hwe_against_enumeration(spark):
    def brute(a, h, c):
        n, rare = a + h + c, 2 * min(a, c) + h

        def weight(x):
            low = (rare - x) // 2
            return math.factorial(n) / (math.factorial(low) * math.factorial(x) * math.factorial(n - x - low)) * 2**x

        w = {x: weight(x) for x in range(rare % 2, rare + 1, 2)}
        return sum(v for v in w.values() if v <= w[h] * (1 + 1e-9)) / sum(w.values())

    cases = [(a, h, c) for a, h, c in itertools.product(range(5), repeat=3) if a + h + c]
    got = genotype.hwe_exact(spark.createDataFrame(cases, "hom_ref long, het long, hom_alt long")).collect()
    for r in got:
        assert math.isclose(r.p_hwe, brute(r.hom_ref, r.het, r.hom_alt), rel_tol=1e-9)


def test_linear_association_against_least_squares(spark):
    rng = np.random.default_rng(3)
    g, y = rng.integers(0, 3, 60), rng.normal(size=60)
    calls = spark.createDataFrame([(i, 1, int(x)) for i, x in enumerate(g)], "sid long, vid long, g int")
    pheno = spark.createDataFrame([(i, float(x)) for i, x in enumerate(y)], "sid long, y double")
    r = assoc.linear_assoc(calls, pheno).withColumn("p", assoc.t_tail("t", (F.col("n") - 2).cast("double"))).first()
    x = np.column_stack([np.ones(60), g])
    beta, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert math.isclose(r.beta, beta[1]) and math.isclose(r.se, math.sqrt(rss[0] / 58 * np.linalg.inv(x.T @ x)[1, 1]))
    t = np.linspace(abs(r.t), abs(r.t) + 400, 4_000_001)
    density = math.exp(math.lgamma(29.5) - math.lgamma(29)) / math.sqrt(58 * math.pi) * (1 + t * t / 58) ** -29.5
    assert math.isclose(r.p, 2 * np.trapezoid(density, t), rel_tol=1e-5)


def test_logistic_falls_back_to_firth_on_separation(spark):
    rows = [(i, 1, int(i >= 10) * 2) for i in range(20)]
    calls = spark.createDataFrame(rows, "sid long, vid long, g int")
    pheno = spark.createDataFrame([(i, int(i >= 10)) for i in range(20)], "sid long, y int")
    assert assoc.logistic_assoc(calls, pheno).first().method == "firth"


def test_global_rank(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1009).alias("p"), F.col("id").cast("string").alias("id"))
    got = [r["rank"] for r in assoc.ranked(df.repartition(7), ["p", "id"]).orderBy("p", "id").collect()]
    assert got == list(range(1, 1001))


def test_lead_hits_keep_their_distance(spark):
    df = spark.createDataFrame([("1", 100, "a", 1e-9), ("1", 400_000, "b", 1e-10), ("1", 1_200_000, "c", 1e-9), ("2", 5, "d", 1e-12), ("2", 9, "e", 1e-3)], "chrom string, pos long, id string, p double")
    assert [r.id for r in assoc.lead_hits(df).collect()] == ["d", "b", "c"]


def test_proportions_sum_to_one_and_find_the_label(spark):
    frequencies = spark.createDataFrame([(k, v, 0.9 if k == "A" else 0.1) for k in "AB" for v in range(40)], "label string, vid long, p double")
    calls = spark.createDataFrame([(1, v, 2) for v in range(40)], "sid long, vid long, g int")
    q = {r.label: r.q for r in genotype.supervised_proportions(calls, frequencies).collect()}
    assert math.isclose(sum(q.values()), 1) and q["A"] > 0.99


def test_confidence_is_between_super_populations(spark):
    d = spark.createDataFrame([(1, "p1", "S", 1.0), (1, "p2", "S", 1.1), (1, "p3", "T", 4.0), (2, "p1", "S", 2.0)], "sid long, population string, super_population string, distance double")
    assert {r.sid: r.confidence for r in ancestry.ancestry_confidence(d).collect()} == {1: 0.75, 2: 1.0}


def test_checks(spark):
    iv = spark.createDataFrame([("1", 1, 10), ("1", 10, 20), ("2", 5, 4)], "chrom string, start long, end long")
    assert {(r.chrom, r.rule) for r in quality.check_intervals(iv).collect()} == {("1", "overlap"), ("2", "reversed")}
    with pytest.raises(ValueError, match="twice"):
        quality.require(quality.duplicates(spark.createDataFrame([(1,), (1,)], "k long"), "k"), "twice")


def _random_calls(spark, n=40, m=60, seed=5):
    rng = np.random.default_rng(seed)
    shift = np.linspace(-1, 1, n)[:, None] * rng.normal(0, 1, m)
    p = 1 / (1 + np.exp(-(shift + rng.normal(0, 0.3, m))))
    g = rng.binomial(2, p)
    return g, spark.createDataFrame([(i, j, int(g[i, j])) for i in range(n) for j in range(m)], "sid long, vid long, g int")


def test_components_against_singular_vectors(spark):
    g, calls = _random_calls(spark)
    p = g.mean(0) / 2
    ok = (p > 0) & (p < 1)
    z = (g[:, ok] - 2 * p[ok]) / np.sqrt(2 * p[ok] * (1 - p[ok]))
    u, _, vt = np.linalg.svd(z, full_matrices=False)
    fit = pooled.fit_pca(calls, 2, rounds=12)
    scores = {(r.pc, r.sid): r.score for r in fit.scores.collect()}
    for j in range(2):
        got = np.array([scores[f"PC{j + 1}", i] for i in range(len(g))])
        assert abs(abs(got @ u[:, j]) - 1) < 1e-6
    weights = np.array([r.w for r in fit.weights.filter("pc = 'PC1'").orderBy("vid").collect()])
    assert abs(abs(weights @ vt[0]) - 1) < 1e-6


def _round_bytes(spark, run):
    """Bytes that a round of run(rounds) shuffles."""
    context = spark.sparkContext._jsc.sc()

    def written():
        context.listenerBus().waitUntilEmpty()
        return context.statusStore().executorList(True).apply(0).totalShuffleWrite()

    totals = []
    for rounds in (1, 4):
        before = written()
        run(rounds).count()
        totals.append(written() - before)
    return (totals[1] - totals[0]) / 3


def _thin_calls(spark):
    """40 000 calls, two a variant, of 1000 samples."""
    return spark.range(40_000).selectExpr("id % 1000 as sid", "id div 2 as vid", "cast(pmod(xxhash64(id), 3) as int) as g")


def test_rounds_within_strata_shuffle_no_row_of_a_call(spark):
    strata = spark.range(1000).selectExpr("id as sid", "id div 500 as stratum")
    assert _round_bytes(spark, lambda rounds: pooled.stratum_pca(_thin_calls(spark), strata, 3, rounds)) < 40_000 * 30


def test_rounds_of_components_shuffle_no_row_of_a_call(spark):
    assert _round_bytes(spark, lambda rounds: pooled.fit_pca(_thin_calls(spark), 3, rounds).scores) < 40_000 * 30


def test_members_of_components_are_found_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    _, calls = _random_calls(spark)
    strata = spark.range(40).selectExpr("id as sid", "id div 20 as stratum").mapInArrow(note, "sid long, stratum long")
    assert pooled.stratum_pca(calls, strata, 3, rounds=2).count() == 120
    assert seen.value == 40


def test_weights_and_frequencies_by_pieces_chunks_and_vectors(spark, monkeypatch):
    for name, value in {"CHUNK": 16, "PIECE": 100, "LEAST": 500, "HELD": 16 * 40 * 3}.items():
        monkeypatch.setattr(subspace, name, value)
    g, calls = _random_calls(spark, seed=10)
    p = g.mean(0) / 2
    ok = np.flatnonzero((p > 0) & (p < 1))
    vt = np.linalg.svd((g[:, ok] - 2 * p[ok]) / np.sqrt(2 * p[ok] * (1 - p[ok])), full_matrices=False)[2]
    fit = pooled.fit_pca(calls, 3, rounds=12)
    assert {r.vid: r.p for r in fit.freqs.collect()} == {int(j): p[j] for j in ok}
    weights = {(r.pc, r.vid): r.w for r in fit.weights.collect()}
    assert len(weights) == 3 * len(ok) and all(abs(abs(np.array([weights[f"PC{k + 1}", j] for j in ok.tolist()]) @ vt[k]) - 1) < 1e-6 for k in range(2))


def test_components_within_strata_by_pieces_chunks_and_vectors(spark, monkeypatch):
    for name, value in {"CHUNK": 16, "PIECE": 100, "LEAST": 500, "HELD": 16 * 81 * 3}.items():
        monkeypatch.setattr(subspace, name, value)
    both = {"a": _random_calls(spark, seed=8), "b": _random_calls(spark, seed=9)}
    calls = both["a"][1].union(both["b"][1].selectExpr("sid + 100", "vid", "g")).union(spark.createDataFrame([(999, 999, 2), (None, 0, 2), (0, None, 1), (0, 998, None)], "sid long, vid long, g int"))
    strata = spark.createDataFrame([(i + shift, s) for s, shift in (("a", 0), ("b", 100)) for i in range(40)] + [(999, "a"), (998, "c"), (997, None)], "sid long, stratum string")
    rows = pooled.stratum_pca(calls, strata, 3, rounds=12).collect()
    assert {(r.stratum, r.sid) for r in rows} == {("a", i) for i in range(40)} | {("b", i + 100) for i in range(40)} and len(rows) == 240
    scores = {(r.stratum, r.pc, r.sid): r.score for r in rows}
    for s, shift in (("a", 0), ("b", 100)):
        g = both[s][0]
        p = g.mean(0) / 2
        ok = (p > 0) & (p < 1)
        u = np.linalg.svd((g[:, ok] - 2 * p[ok]) / np.sqrt(2 * p[ok] * (1 - p[ok])), full_matrices=False)[0]
        for j in range(2):
            got = np.array([scores[s, f"PC{j + 1}", i + shift] for i in range(40)])
            assert abs(abs(got @ u[:, j]) - 1) < 1e-6 and (got**3).sum() >= 0


def test_pooled_score_test_against_projection(spark):
    g, calls = _random_calls(spark, seed=6)
    rng = np.random.default_rng(7)
    n, m = g.shape
    x, y, off = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    v = spark.createDataFrame([(j, "1" if j % 2 else "2") for j in range(m)], "vid long, chrom string")
    pheno = spark.createDataFrame([(i, float(y[i]), float(x[i])) for i in range(n)], "sid long, y double, x double")
    loco = spark.createDataFrame([(i, "1", float(off[i])) for i in range(n)], "sid long, chrom string, pred double")
    got = {r.vid: r for r in pooled.pooled_assoc(calls, v, pheno, ["x"], loco).collect()}
    c = np.column_stack([np.ones(n), x])
    away = np.eye(n) - c @ np.linalg.pinv(c)
    for j in range(m):
        r, h = away @ (y - off if j % 2 else y), away @ g[:, j]
        if h @ h < 1e-9:
            assert j not in got
            continue
        chi2 = (h @ r) ** 2 / ((r @ r / (n - 2)) * (h @ h))
        assert math.isclose(got[j].chi2, chi2, rel_tol=1e-8, abs_tol=1e-10)
        assert math.isclose(got[j].p, math.erfc(math.sqrt(chi2 / 2)), rel_tol=1e-8)


def _nearest(pos, per_chrom):
    free, taken = sorted(pos), []
    for t in np.linspace(min(pos), max(pos), per_chrom):
        if free:
            taken.append(min(free, key=lambda x: (abs(x - t), x)))
            free.remove(taken[-1])
    return sorted(taken)


def test_spaced_pool_against_plain_search(spark):
    rng = np.random.default_rng(3)
    pos = sorted({*rng.integers(1, 200, 60).tolist(), *rng.integers(5000, 9000, 25).tolist(), 40_000})
    v = spark.createDataFrame([("1", p) for p in pos] + [("2", 7)], "chrom string, pos long")
    pool = pooled.spaced_pool(v, 12)
    assert sorted(r.pos for r in pool.filter("chrom = '1'").collect()) == _nearest(pos, 12)
    assert [r.pos for r in pool.filter("chrom = '2'").collect()] == [7]
    got = sorted(r.pos for r in pooled.spaced_markers(pool, 6, 50).filter("chrom = '1'").collect())
    assert got and all(b - a >= 50 for a, b in itertools.pairwise(got))


def test_sex_check_excludes_mismatches(spark):
    rng = np.random.default_rng(9)
    calls = spark.createDataFrame([(i, j, int(rng.choice([0, 2]) if i % 2 else rng.binomial(2, 0.5))) for i in range(20) for j in range(300)], "sid long, vid long, g int")
    stated = spark.createDataFrame([(i, "1" if i % 2 or i == 4 else "2", "1" if i % 2 else "2") for i in range(20)], "sid long, sex string, ped_sex string")
    out = pooled.sex_check(calls, stated, "exclude", female=0.4)
    assert [r.sid for r in out.remove.collect()] == [4] and out.keep.count() == 19
    with pytest.raises(ValueError, match="4"):
        pooled.sex_check(calls, stated, "fail", female=0.4)


def test_log_metrics(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\n1,234 variants loaded.\n99 variants loaded.\n")
    got = {r.metric: r.value for r in reports.log_metrics(spark, str(tmp_path), {"loaded": r"^([0-9,]+) variants", "none": "^(zzz)"}).collect()}
    assert got == {"loaded": "1234", "none": "NA"}


def test_a_crowded_locus_raises(spark, monkeypatch):
    monkeypatch.setattr(variants, "LOCUS_ROWS", 3)
    rows = [("1", 5, f"v{i}", "A", "ACGT"[1 + i % 3], "PR") for i in range(4)]
    ref = spark.createDataFrame(rows[:3], "chrom string, pos long, id string, ref string, alt string, info string")
    study = spark.createDataFrame(rows, ref.schema)
    assert variants.harmonize_variants(ref, ref).mapping.count() == 0
    with pytest.raises(Exception, match="more than 3 records at locus 1:5"):
        variants.harmonize_variants(ref, study).mismatches.collect()


def test_harmonization_shuffles_once(spark):
    ref = spark.createDataFrame([("1", 5, "rs1", "A", "C", ".")], "chrom string, pos long, id string, ref string, alt string, info string")
    for out in variants.harmonize_variants(ref, ref):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(chrom") == (1 if out.columns[0] == "harmonized_id" else 2)  # keys and roll-up are both read by the second


@pytest.mark.parametrize("given, want", [(" 1", None), ("1 ", None), ("1d", None), ("1F", None), ("0x1p3", None), ("0X1p3", None), ("-Infinity", None), ("inf", None), ("-1e999", None), ("+5", 5.0), ("-0.25", -0.25), ("1e5", 1e5), ("--1", None), (",1", None), ("1,5", None), ("", None), (None, None), ("7/8", None), ("1\t", None)])
def test_decimal_numbers_only(spark, given, want):
    got = spark.createDataFrame([(given,)], "c string").select(E.finite("c").alias("x"), E.bounded(E.decimal("c")).alias("y")).first()
    assert got.x == want and got.y == want


def test_sets_are_compared_by_all_tasks(spark):
    """Rows repeat, are null and come from one partition; none is grouped before rows are dealt out."""
    one = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, None), (3, "c")], "x int, y string").coalesce(1)
    other = spark.createDataFrame([(1, "a"), (None, None), (None, None), (2, "b"), (2, "b")], "x int, y string").coalesce(1)
    found = quality.same_set(one, other)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[plan.index("REPARTITION_BY_NUM") :]
    assert found.columns == ["x", "y", "side"]
    assert sorted(map(tuple, found.collect()), key=str) == [(2, "b", "right"), (2, None, "left"), (3, "c", "left")]
    assert quality.same_set(one, one).isEmpty() and quality.same_set(one, one.filter("x > 5")).count() == 4
