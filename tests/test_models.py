"""Models, orders and checks against plain NumPy and Python."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import ancestry, assoc, genotype, manifest, pooled, quality, samples, summaries, variants
from helixframe.sources import io


def _calls(spark, n=60, m=12, seed=1, missing=0.1):
    rng = np.random.default_rng(seed)
    g = rng.binomial(2, rng.uniform(0.2, 0.5, m), (n, m)).astype(float)
    g[rng.random((n, m)) < missing] = np.nan
    rows = [(i, j, None if np.isnan(g[i, j]) else int(g[i, j])) for i in range(n) for j in range(m)]
    return g, spark.createDataFrame(rows, "sid long, vid long, g int"), rng


def test_linear_with_covariates_against_least_squares(spark):
    g, calls, rng = _calls(spark)
    n, m = g.shape
    x, y = rng.normal(size=(n, 2)), rng.normal(size=n)
    pheno = spark.createDataFrame([(i, None if i == 3 else float(y[i]), float(x[i, 0]), float(x[i, 1]), 1.0) for i in range(n)], "sid long, y double, a double, b double, c double")
    got = {r.vid: r for r in assoc.linear_assoc(calls, pheno, ["a", "b"]).collect()}
    for j in range(m):
        ok = ~np.isnan(g[:, j]) & (np.arange(n) != 3)
        z = np.column_stack([np.ones(ok.sum()), x[ok], g[ok, j]])
        beta, rss, *_ = np.linalg.lstsq(z, y[ok], rcond=None)
        se = math.sqrt(rss[0] / (ok.sum() - 4) * np.linalg.inv(z.T @ z)[3, 3])
        assert got[j].n == ok.sum() and math.isclose(got[j].beta, beta[3], rel_tol=1e-7) and math.isclose(got[j].se, se, rel_tol=1e-7)
    plain = {r.vid: r.beta for r in assoc.linear_assoc(calls, pheno).collect()}
    constant = {r.vid: r.beta for r in assoc.linear_assoc(calls, pheno, ["c"]).collect()}
    assert all(math.isclose(plain[j], constant[j], rel_tol=1e-7) for j in plain)


def test_logistic_with_covariates_against_newton(spark):
    g, calls, rng = _calls(spark, 120, 3, 2, 0)
    n, m = g.shape
    x = rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.5 * x + 0.4 * g[:, 0])))).astype(int)
    pheno = spark.createDataFrame([(i, int(y[i]), float(x[i])) for i in range(n)], "sid long, y int, x double")
    for r in assoc.logistic_assoc(calls, pheno, ["x"]).collect():
        z, w = np.column_stack([np.ones(n), g[:, r.vid], x]), np.zeros(3)
        for _ in range(50):
            mu = 1 / (1 + np.exp(-z @ w))
            w = w + np.linalg.solve((z * (mu * (1 - mu))[:, None]).T @ z, z.T @ (y - mu))
        assert math.isclose(r.beta, w[1], rel_tol=1e-6) and r.method == "irls"


def test_males_count_twice_on_x(spark):
    calls = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (1, 2, 1), (1, 1, None)], "sid long, vid long, g int")
    v = spark.createDataFrame([(1, "X"), (2, "1")], "vid long, chrom string")
    got = sorted((r.sid, r.vid, -1 if r.g is None else r.g) for r in assoc.male_x(calls, v, spark.createDataFrame([(1,)], "sid long")).collect())
    assert got == [(1, 1, -1), (1, 1, 2), (1, 2, 1), (2, 1, 1)]


def test_binary_pooled_test_against_projection(spark):
    g, calls, rng = _calls(spark, 150, 8, 3)
    n, m = g.shape
    x, off = rng.normal(size=n), rng.normal(0, 0.3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x + np.nan_to_num(g[:, 0]) * 1.8 - 1.5)))).astype(float)
    v = spark.createDataFrame([(j, "1" if j % 2 else "2") for j in range(m)], "vid long, chrom string")
    pheno = spark.createDataFrame([(i, int(y[i]), float(x[i])) for i in range(n)], "sid long, y int, x double")
    loco = spark.createDataFrame([(i, "1", float(off[i])) for i in range(n)], "sid long, chrom string, pred double")
    got = {r.vid: r for r in pooled.pooled_binary(calls, v, pheno, ["x"], loco, firth_p=0.05).collect()}
    z = np.column_stack([np.ones(n), x])
    assert any(r.test == "firth" for r in got.values()) and any(r.test == "score" for r in got.values())
    for j in range(m):
        o = off if j % 2 else np.zeros(n)
        w = np.zeros(2)
        for _ in range(60):
            mu = 1 / (1 + np.exp(-(z @ w + o)))
            w = w + np.linalg.solve((z * (mu * (1 - mu))[:, None]).T @ z, z.T @ (y - mu))
        mu = 1 / (1 + np.exp(-(z @ w + o)))
        d = mu * (1 - mu)
        h = np.where(np.isnan(g[:, j]), np.nanmean(g[:, j]), g[:, j])
        a = np.linalg.solve((z * d[:, None]).T @ z, z.T @ (d * h))
        u, var = h @ (y - mu), d @ (h * h) - a @ (z.T @ (d * h))
        if got[j].test == "score":
            assert math.isclose(got[j].chi2, u * u / var, rel_tol=1e-6, abs_tol=1e-9)
            continue
        called = ~np.isnan(g[:, j])
        r, eta = (g[:, j] - z @ a)[called], (z @ w + o)[called]

        def level(b, r=r, eta=eta, called=called):
            p = 1 / (1 + np.exp(-(eta + b * r)))
            return float(np.sum(y[called] * np.log(p) + (1 - y[called]) * np.log(1 - p)) + 0.5 * np.log(np.sum(p * (1 - p) * r * r)))

        best = max(np.linspace(-6, 6, 24_001), key=level)
        assert abs(got[j].beta - best) < 1e-3 and math.isclose(got[j].chi2, 2 * (level(best) - level(0)), rel_tol=1e-4)


def test_chi2_tail(spark):
    xs = [0.0, 1e-9, 0.5, 3.9, 7.99, 8.01, 30.0, 300.0, 1200.0, None]
    got = [r.p for r in spark.createDataFrame([(x,) for x in xs], "x double").select(pooled.chi2_tail("x").alias("p")).collect()]
    assert got[-1] is None and all(math.isclose(p, math.erfc(math.sqrt(x / 2)), rel_tol=1e-9) for p, x in zip(got, xs[:-1], strict=False))


@pytest.mark.parametrize("ps", [[0.3], [0.1, 0.9], [0.5] * 7, [*np.linspace(0.001, 1, 4001)], [0.2, 0.2, 0.2, 0.8, None, 2.0, 0.0], []])
def test_lambda_is_the_middle(spark, ps):
    from statistics import NormalDist

    df = spark.createDataFrame([(str(i), None if p is None else float(p)) for i, p in enumerate(ps)], "id string, p double").repartition(5)
    good = sorted(p for p in ps if p and 0 < p <= 1)
    got = assoc.genomic_lambda(df).first()[0]
    if not good:
        assert got is None
        return
    middle = {good[(len(good) - 1) // 2], good[len(good) // 2]} if good[(len(good) - 1) // 2] != good[len(good) // 2] else {good[len(good) // 2]}
    want = np.mean([NormalDist().inv_cdf(p / 2) ** 2 if p < 1 else 0.0 for p in middle]) / 0.454936423119572
    assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-12)


def test_ancestry_in_three_components_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, i % 2, *map(float, rng.normal(i % 2 * 3, 1, 3))) for i in range(60)] + [(99, 7, 7, 1.0, 2.0, 3.0)]
    ref = spark.createDataFrame(rows, "sid long, population long, super_population long, a double, b double, c double")
    got = {(r.sid, r.population): r.distance for r in ancestry.population_distances(ref, ancestry.population_models(ref, ["a", "b", "c"]), ["a", "b", "c"]).collect()}
    for p in (0, 1, 7):
        x = np.array([r[3:] for r in rows if r[1] == p])
        cov = np.cov(x.T) + 1e-4 * np.eye(3) if len(x) > 1 else np.eye(3)
        for r in rows:
            d = np.array(r[3:]) - x.mean(0)
            assert math.isclose(got[r[0], p], math.sqrt(d @ np.linalg.inv(cov) @ d), rel_tol=1e-6, abs_tol=1e-7)
    with pytest.raises(ValueError, match="without a model"):
        ancestry.assign_ancestry(ref, ref, ["a", "b", "c"], [0, 1, 8])


def test_unrelated_against_plain_removal(spark):
    rng = np.random.default_rng(8)
    g = rng.binomial(2, 0.4, (24, 200))
    for a, b in ((1, 0), (2, 0), (3, 2), (10, 9), (11, 9), (12, 9), (20, 19)):
        same = rng.random(200) < 0.8
        g[a, same] = g[b, same]
    calls = spark.createDataFrame([(i, j, int(g[i, j])) for i in range(24) for j in range(200)], "sid long, vid long, g int")
    pairs = [(r.a, r.b) for r in genotype.kinship_pairs(calls).filter("phi > 0.0884").collect()]
    assert len(pairs) >= 7
    links = {i: {b if a == i else a for a, b in pairs if i in (a, b)} for i in range(24)}
    gone = set()
    while any(links.values()):
        worst = max(links, key=lambda s: (len(links[s]), s))
        for o in links.pop(worst):
            links[o].discard(worst)
        gone.add(worst)
    assert {r.sid for r in genotype.unrelated(calls).collect()} == set(range(24)) - gone


def test_families_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60, 2)] + [(i + 1, i + 2) for i in range(0, 60, 2)] + [(100, 101)]
    got = {r.sid: r.family for r in genotype.families(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_families_spread_one_link_a_sample(spark, monkeypatch):
    """A crowd of 200 related samples has 19900 links; a task keeps at most one for each of its samples."""
    seen = []
    monkeypatch.setattr(genotype, "written", lambda df, name, written=genotype.written: seen.append((name, written(df, name))) or seen[-1][1])
    edges = [(a, b) for a in range(200) for b in range(a + 1, 200)] + [(300, 301), (302, 301), (305, 305)]
    got = {r.sid: r.family for r in genotype.families(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == dict.fromkeys(range(200), 0) | {300: 300, 301: 300, 302: 300, 305: 305}
    assert dict(seen)["links"].count() <= 3 * 204


def test_inverse_normal_with_ties(spark):
    from statistics import NormalDist

    df = spark.createDataFrame([(0, 5.0), (1, 1.0), (2, 5.0), (3, None), (4, 9.0)], "sid long, y double")
    got = {r.sid: r.z for r in assoc.rank_inverse_normal(df, "y", "sid", "z").collect()}
    q = lambda r: NormalDist().inv_cdf((r - 0.375) / 4.25)
    want = {0: q(2.5), 1: q(1), 2: q(2.5), 3: None, 4: q(4)}
    assert all(got[i] is None if w is None else math.isclose(got[i], w, abs_tol=1e-9) for i, w in want.items())


def test_metrics_of_odd_labels(spark):
    rows = [("1", 0.5, 10), ("chr22", 1e-9, 11), ("Y", 0.1, 1), ("MT", 0.1, 1), ("X", 0.2, 7), ("PAR1", 1e-6, 3), ("25", None, 5), ("GL1", 0.3, 0), (None, 0.4, 2)]
    df = spark.createDataFrame(rows, "chrom string, p double, n long")
    got = {r.metric: r.value for r in assoc.assoc_metrics(df).collect()}
    assert got == {"total_variants": 9, "valid_p": 8, "genome_wide": 1, "suggestive": 2, "autosomal_rows": 2, "x_rows": 3, "autosomal_valid_p": 2, "x_valid_p": 2, "min_p": 1e-9, "x_samples_min": 3, "x_samples_max": 7}
    keys = [r.chrom_key for r in assoc.manhattan_layout(df.withColumn("pos", df.n + 1)).orderBy("chrom_key").collect()]
    assert keys == [1, 22, 23, 24, 25, 26, 1001, 1002]


def test_wanted_test_must_be_there(spark):
    raw = spark.createDataFrame([("DOMDEV", "a"), ("HET", "b")], "TEST string, ID string")
    with pytest.raises(ValueError, match="DOMDEV, HET"):
        assoc.normalize_sumstats(raw, "t", "a", "b")


def test_a_spelling_of_two_samples_is_an_error(spark):
    ids = "fid string, iid string"
    with pytest.raises(ValueError, match="several samples"):
        samples.match_samples(spark.createDataFrame([("F9", "I1")], ids), spark.createDataFrame([("F1", "I1"), ("F2", "I1")], ids)).collect()
    with pytest.raises(ValueError, match="lacks"):
        samples.canonicalize_ids(spark.createDataFrame([("F9", "I9")], ids), spark.createDataFrame([("F1", "I1")], ids))
    with pytest.raises(ValueError, match="reference and study"):
        t = spark.createDataFrame([("F1", "I1")], ids)
        samples.merge_cohorts(t, t, t.selectExpr("*", "'x' as label"))


def test_overlaps_across_stretches(spark):
    wide = quality.STRETCH
    iv = spark.createDataFrame([("1", 5, 3 * wide), ("1", 2 * wide, 2 * wide + 1), ("1", 3 * wide + 1, 3 * wide + 9), ("2", 1, 2)], "chrom string, start long, end long")
    assert [(r.start, r.rule) for r in quality.check_intervals(iv).collect()] == [(2 * wide, "overlap")]
    v = spark.createDataFrame([("1", 9, 1), ("1", 8, variants.STRETCH * 3), ("1", 10, variants.STRETCH * 3 + 1)], "chrom string, pos long, row_number long")
    assert [(r.chrom, r.n) for r in variants.unsorted_rows(v).collect()] == [("1", 1)]


def test_fingerprints_ignore_order(spark):
    rows = [(f"p{i}", f"h{i * 7 % 50}", i) for i in range(500)]
    a = spark.createDataFrame(rows, "path string, sha256 string, size_bytes long")
    b = spark.createDataFrame(rows[::-1], a.schema).repartition(7)
    one = manifest.wide_fingerprint(a).first()[0]
    assert manifest.wide_fingerprint(b).first()[0] == one and manifest.wide_fingerprint(a.filter("size_bytes <> 3")).first()[0] != one
    assert len(one) == 64 and manifest.content_fingerprint(a).first()[0] == manifest.content_fingerprint(b).first()[0]


def test_a_fingerprint_of_all_is_that_of_the_sorted_text(spark):
    """Of the whole table and of tables without lines; the registered one has one row, of all parts."""
    import hashlib

    from helixframe import catalog

    rows = [(f"p/{i}", f"h{i * 7 % 50}", i) for i in range(3000)]
    text = "".join(f"{p}\t{h}\t{n}\n" for p, h, n in sorted(rows))
    table = spark.createDataFrame(rows, "path string, sha256 string, size_bytes long").repartition(5)
    assert manifest.content_fingerprint(table).first()[0] == hashlib.sha256(text.encode()).hexdigest()
    assert [r.fingerprint for r in manifest.content_fingerprint(table.filter("false")).collect()] == [None]
    assert catalog.QUERIES["content_fingerprint"](spark, "/root/testdata/sf0.001").count() == 1


def test_large_families_are_thinned_as_plain_ones(spark, monkeypatch):
    """One family of many links: each removal is one look at the degrees."""
    rng = np.random.default_rng(31)
    links = {(int(a), int(b)) for a, b in np.sort(rng.integers(0, 900, (60_000, 2)), 1) if a != b}
    related = spark.createDataFrame(sorted(links), "a long, b long")
    monkeypatch.setattr(genotype, "kinship_pairs", lambda calls, cutoff: related)
    calls = spark.range(1000).withColumnRenamed("id", "sid")
    left = {r.sid for r in genotype.unrelated(calls, tiled=calls).collect()}
    of = {s: set() for s in range(1000)}
    for a, b in links:
        of[a].add(b)
        of[b].add(a)
    while any(of.values()):
        worst = max(of, key=lambda s: (len(of[s]), s))
        for other in of.pop(worst):
            of[other].discard(worst)
    assert left == set(of)


def test_records_of_several_files(spark, tmp_path):
    from helixframe.sources import io

    spark.range(50).repartition(5).write.csv(str(tmp_path / "t"), header=True)
    assert [r.n for r in io.count_records(spark, str(tmp_path / "t")).collect()] == [50]


def test_bed_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    g = rng.integers(-1, 3, (1100, 7))  # variants x samples
    code = {2: 0, -1: 1, 1: 2, 0: 3}
    body = b"".join(bytes(sum(code[int(x)] << 2 * k for k, x in enumerate(row[i : i + 4])) for i in range(0, 7, 4)) for row in g)
    (tmp_path / "x.bed").write_bytes(b"\x6c\x1b\x01" + body)
    (tmp_path / "x.fam").write_text("f i 0 0 0 0\n" * 7)
    (tmp_path / "x.bim").write_text("1 v 0 1 A G\n" * 1100)
    got = io.read_bed(spark, str(tmp_path / "x"), 100).collect()
    assert len(got) == 7700 and all((-1 if r.g is None else r.g) == g[r.vid, r.sid] for r in got)
    (tmp_path / "x.bed").write_bytes(b"\x6c\x1b\x01" + body[:-1])
    with pytest.raises(ValueError, match="BED"):
        io.read_bed(spark, str(tmp_path / "x"))


def test_association_files(spark, tmp_path):
    (tmp_path / "run.y.glm.linear").write_text("#CHROM\tPOS\tID\tP\n1\t5\ta\t0.5\n")
    (tmp_path / "run.y.glm.log").write_text("no table\n")
    assert [r.asDict() for r in io.read_glm(spark, str(tmp_path / "run")).collect()] == [{"CHROM": "1", "POS": "5", "ID": "a", "P": "0.5"}]
    with pytest.raises(ValueError, match="no association table"):
        io.read_glm(spark, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="lacks"):
        io.named_assoc(spark.createDataFrame([("1", 0.5)], "CHROM string, P double"), rare=True)


def test_matrix_rows_have_their_place_in_any_number_of_partitions(spark, tmp_path):
    (tmp_path / "q").write_text("\n".join(f"{i} {i / 7}" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.place: r["values"][0] for r in io.read_matrix(spark, str(tmp_path / "q"), 2).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: float(i) for i in range(5000)}


def test_sex_markers_and_y_calls(spark):
    rng = np.random.default_rng(4)
    v = spark.createDataFrame([(j, "X" if j < 300 else "Y", 5_000_000 + j * 1000) for j in range(320)], "vid long, chrom string, pos long")
    rows = [(i, j, (int(rng.choice([0, 2]) if i % 2 else rng.binomial(2, 0.5)) if j < 300 else (int(rng.choice([0, 2])) if i % 2 else None))) for i in range(12) for j in range(320)]
    calls = spark.createDataFrame(rows, "sid long, vid long, g int")
    stated = spark.createDataFrame([(i, "1" if i % 2 else "2", "1" if i % 2 else "2") for i in range(12)], "sid long, sex string, ped_sex string")
    markers = pooled.sex_markers(v, calls, "GRCh38", 0.05, 0.5)
    got = {r.sid: (r.genetic, r.y_called) for r in pooled.sex_check(calls, stated, female=0.4, markers=markers).detail.collect()}
    assert got == {i: ("1", 1.0) if i % 2 else ("2", 0.0) for i in range(12)}
    assert {r.metric: r.value for r in summaries.sex_check_summary(pooled.sex_check(calls, stated, female=0.4).detail, "warn", markers).collect()}["y_markers"] == "20"


def test_range_joins_of_genes_equal_plain_search(spark):
    rng = np.random.default_rng(2)
    v = [(i, str(c), int(p)) for i, (c, p) in enumerate(zip(rng.integers(1, 3, 300), rng.integers(1, 400_000, 300), strict=True))]
    genes = [(f"g{i}", str(int(c)), int(s), int(s + w)) for i, (c, s, w) in enumerate(zip(rng.integers(1, 3, 40), rng.integers(1, 390_000, 40), rng.integers(0, 150_000, 40), strict=True))]
    got = {(r.gene, r.vid) for r in genotype.in_genes(spark.createDataFrame(v, "vid long, chrom string, pos long"), spark.createDataFrame(genes, "gene string, chrom string, start long, end long")).collect()}
    assert got == {(g, i) for (i, c, p), (g, d, s, e) in itertools.product(v, genes) if c == d and s <= p <= e}


def test_htp_faults_raise(spark):
    row = ("v", 0.01, 0.1, 4, 2, 1, 1, 3, 3, 0, 0)
    names = "name string, p double, aaf double, num_cases long, cases_ref long, cases_het long, cases_alt long, num_controls long, controls_ref long, controls_het long, controls_alt long"
    good = spark.createDataFrame([row], names)
    assert [(r.mac, r.mac_bin) for r in assoc.htp_mac(good, True).collect()] == [(3.0, "2-5")]
    assert math.isclose(assoc.htp_mac(good, True, dosage=True).first().mac, 1.4)
    bad = spark.createDataFrame([("a", 0.01, 1.5, *row[3:]), ("b", 0.01, 0.1, 4, 2, -1, 3, 3, 3, 0, 0), ("c", 0.01, 0.1, 9, *row[4:]), ("d", 0.01, 0.0, 4, 4, 0, 0, 3, 3, 0, 0), ("e", None, 9.0, *row[3:])], names)
    assert {(r.name, r.problem) for r in assoc.htp_mac_problems(bad, True).collect()} == {("a", "frequency"), ("b", "counts"), ("c", "totals"), ("d", "mac")}
    with pytest.raises(ValueError, match="allele count"):
        assoc.htp_mac(bad, True)


def test_ridge_without_a_chromosome_against_numpy(spark):
    from helixframe.operators import ridge

    g, calls, rng = _calls(spark, 90, 14, 9)
    n, m = g.shape
    chrom = ["1" if j < 6 else "2" if j < 11 else "3" for j in range(m)]
    x = rng.normal(size=n)
    y = np.nan_to_num(g) @ rng.normal(size=m) + x + rng.normal(size=n)
    v = spark.createDataFrame([(j, chrom[j], 100 - j) for j in range(m)], "vid long, chrom string, pos long")
    pheno = spark.createDataFrame([(i, float(y[i]), float(x[i])) for i in range(n)], "sid long, y double, x double")
    got = {(r.sid, r.chrom): r.pred for r in ridge.fit_ridge_loco(calls, v, pheno, ["x"], block=4, shares=(0.2, 0.6)).collect()}
    fold = np.array([r.f for r in spark.range(n).selectExpr("id", "pmod(xxhash64(id, 7), 5) as f").orderBy("id").collect()])
    c = np.column_stack([np.ones(n), x])
    r = y - c @ np.linalg.lstsq(c, y, rcond=None)[0]
    z = np.nan_to_num((g - np.nanmean(g, 0)) / np.nanstd(g, 0))
    columns, names = [], []
    for name in "123":
        order = [j for j in range(m) if chrom[j] == name][::-1]
        for at in range(0, len(order), 4):
            b = z[:, order[at : at + 4]]
            for share in (0.2, 0.6):
                out = np.zeros(n)
                for k in range(5):
                    a = b[fold != k]
                    out[fold == k] = b[fold == k] @ np.linalg.solve(a.T @ a + b.shape[1] * (1 - share) / share * np.eye(b.shape[1]), a.T @ r[fold != k])
                columns.append(out / np.sqrt(np.mean(out**2)))
                names.append(name)
    h = np.column_stack(columns)

    def weights(rows, share):
        return np.linalg.solve(h[rows].T @ h[rows] + h.shape[1] * (1 - share) / share * np.eye(h.shape[1]), h[rows].T @ r[rows])

    best = min((0.2, 0.6), key=lambda s: sum(np.sum((r[fold == k] - h[fold == k] @ weights(fold != k, s)) ** 2) for k in range(5)))
    w = weights(np.ones(n, bool), best)
    for name in "123":
        keep = np.array([x != name for x in names])
        want = h[:, keep] @ w[keep]
        assert np.allclose([got[i, name] for i in range(n)], want, atol=1e-6)


def test_binary_ridge_against_newton(spark):
    """The same two levels with a logistic level 1, in NumPy."""
    from helixframe.operators import ridge

    g, calls, rng = _calls(spark, 160, 10, 21)
    n, m = g.shape
    chrom = ["1" if j < 4 else "2" if j < 7 else "3" for j in range(m)]
    x = rng.normal(size=n)
    liability = np.nan_to_num(g) @ rng.normal(size=m) + x + rng.normal(size=n)
    y = (liability > np.quantile(liability, 0.7)).astype(float)
    v = spark.createDataFrame([(j, chrom[j], 5 + j) for j in range(m)], "vid long, chrom string, pos long")
    pheno = spark.createDataFrame([(i, float(y[i]), float(x[i])) for i in range(n)], "sid long, y double, x double")
    shares = (0.3, 0.7)
    got = {(r.sid, r.chrom): r.pred for r in ridge.fit_ridge_loco(calls, v, pheno, ["x"], block=4, shares=shares, binary=True).collect()}
    fold = np.array([r.f for r in spark.range(n).selectExpr("id", "pmod(xxhash64(id, 7), 5) as f").orderBy("id").collect()])
    c = np.column_stack([np.ones(n), x])
    r = y - c @ np.linalg.lstsq(c, y, rcond=None)[0]
    z = np.nan_to_num((g - np.nanmean(g, 0)) / np.nanstd(g, 0))
    columns, names = [], []
    for name in "123":
        b = z[:, [j for j in range(m) if chrom[j] == name]]
        for share in shares:
            out = np.zeros(n)
            for k in range(5):
                a = b[fold != k]
                out[fold == k] = b[fold == k] @ np.linalg.solve(a.T @ a + b.shape[1] * (1 - share) / share * np.eye(b.shape[1]), a.T @ r[fold != k])
            columns.append(out / np.sqrt(np.mean(out**2)))
            names.append(name)
    h = np.column_stack(columns)

    def newton(x, y, offset, penalty):
        w = np.zeros(x.shape[1])
        for _ in range(50):
            mu = 1 / (1 + np.exp(-(offset + x @ w)))
            w = w + np.linalg.solve((x * (mu * (1 - mu))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (y - mu) - penalty * w)
        return w

    offset = c @ newton(c, y, 0.0, 0.0)
    fit = lambda rows, share: newton(h[rows], y[rows], offset[rows], h.shape[1] * (1 - share) / share)

    def lost(share):
        eta = np.concatenate([offset[fold == k] + h[fold == k] @ fit(fold != k, share) for k in range(5)])
        truth = np.concatenate([y[fold == k] for k in range(5)])
        return np.sum(np.logaddexp(0, eta) - truth * eta)

    w = fit(np.ones(n, bool), min(shares, key=lost))
    for name in "123":
        keep = np.array([x != name for x in names])
        assert np.allclose([got[i, name] for i in range(n)], h[:, keep] @ w[keep], atol=1e-5)
    with pytest.raises(ValueError, match="48 cases and 112 controls"):
        ridge.fit_ridge_loco(calls, v, pheno, ["x"], block=4, binary=True, min_cases=49)
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        ridge.fit_ridge_loco(calls, v, pheno.withColumn("y", F.col("y") + 1), ["x"], block=4, binary=True)


def test_intervals_of_any_length_equal_plain_search(spark):
    rng = np.random.default_rng(4)
    iv = [("1", int(a), int(a + rng.choice([-5, 0, 3, 40_000]))) for a in rng.integers(1, 400_000, 60)] + [("2", 0, 3_000_000_000), ("2", 5, 9), ("3", 10, 20), ("3", 21, 30), ("3", 40, 40)]
    at = [("1", int(p)) for p in rng.integers(0, 450_000, 3000)] + [("2", 0), ("2", 1), ("2", 3_000_000_000), ("2", 3_000_000_001), ("4", 3)] + [("3", p) for p in range(8, 43)]
    v = spark.createDataFrame(at, "chrom string, pos long")
    table = spark.createDataFrame(iv, "chrom string, start long, end long")
    for zero in (False, True):
        inside = lambda c, p: any(c == x and (a <= p - 1 < b if zero else a <= p <= b) for x, a, b in iv)  # noqa: E731, B023
        got = sorted((r.chrom, r.pos) for r in variants.in_intervals(v, table, zero_based=zero).collect())
        assert got == sorted(x for x in at if inside(*x))
        merged = sorted((r.chrom, r.start, r.end) for r in variants.disjoint_intervals(table, zero).collect())
        assert all(a[0] != b[0] or a[2] + (not zero) < b[1] for a, b in itertools.pairwise(merged))
    assert [r for r in merged if r[0] == "3"] == [("3", 10, 20), ("3", 21, 30)]


def test_split_tables_are_not_split_again(spark):
    rows = [("X", 2_700_000), ("PAR1", 100), ("chr1", 5)]
    v = spark.createDataFrame(rows, "chrom string, pos long")
    assert [r.chrom for r in variants.split_par(v, "GRCh38").orderBy("pos").collect()] == ["1", "PAR1", "X"]
    assert [r.chrom for r in variants.split_par(v.filter("chrom <> 'PAR1'"), "GRCh38").orderBy("pos").collect()] == ["1", "PAR1"]


def test_writes_are_checked_in_one_pass(spark, tmp_path):
    v = spark.createDataFrame([(str(1 + i % 22), i) for i in range(66)], "chrom string, pos long")
    io.write_by_chrom(v, str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 66
    for bad, what in ((v.filter("chrom not in ('7', '9')"), "no variants on 7, 9"), (v.unionByName(v.limit(2).withColumn("chrom", F.lit(None).cast("string"))), "2 variants have no chromosome")):
        with pytest.raises(ValueError, match=what):
            io.write_by_chrom(bad, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="there already"):
        io.write_by_chrom(v, str(tmp_path / "good"))
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["good"]


def test_sex_limits_and_paths(spark):
    assert pooled.sex_limits() == pooled.sex_limits("", None, " ") == (0.2, 0.8, None, None)
    assert pooled.sex_limits("0.3", 0.7, 0.1, "0.5") == (0.3, 0.7, 0.1, 0.5)
    for given, what in (({"max_female_xf": 0.3}, "both max_female_xf"), ({"max_female_yrate": 0.3, "min_male_yrate": 0.4}, "both max_female_xf"), ({"max_female_xf": 0.3, "min_male_xf": 0.7, "min_male_yrate": 0.4}, "both max_female_yrate"), ({"max_female_xf": "low", "min_male_xf": 0.7}, "no number")):
        with pytest.raises(ValueError, match=what):
            pooled.sex_limits(**given)
    rng = np.random.default_rng(3)
    people = spark.createDataFrame([(0, "2", "2"), (1, "1", "1"), (2, "1", "1"), (3, "2", "2")], "sid long, sex string, ped_sex string")
    g = np.stack([rng.binomial(2, 0.5, 200) if s in (0, 3) else 2 * rng.binomial(1, 0.5, 200) for s in range(4)])
    x = [(s, v, int(g[s, v])) for s in range(4) for v in range(200)]
    y = [(s, 1000 + v, 0 if s in (1, 3) else None) for s in range(4) for v in range(20)]  # a man without Y calls, a woman with them
    calls = spark.createDataFrame(x + y, "sid long, vid long, g int")
    markers = spark.createDataFrame([(v, "X") for v in range(200)] + [(1000 + v, "Y") for v in range(20)], "vid long, chrom string")
    plain = {r.sid: r.genetic for r in pooled.sex_check(calls, people, markers=markers, limits=pooled.SexLimits(0.5, 0.5)).detail.collect()}
    assert plain == {0: "2", 1: "1", 2: "1", 3: "2"}
    rated = pooled.sex_check(calls, people, "exclude", markers=markers, limits=pooled.SexLimits(0.5, 0.5, 0.3, 0.7))
    assert {r.sid: r.genetic for r in rated.detail.collect()} == {0: "2", 1: "1", 2: "0", 3: "0"}
    none = markers.filter("chrom = 'Y'")
    with pytest.raises(ValueError, match="X markers"):
        pooled.sex_check(calls, people, markers=none)
    for out, status in ((pooled.sex_check(calls, people, markers=none, allow_no_x=True), "no_sex_chromosome_markers"), (pooled.sex_check(calls, people, "fail", enabled=False), "disabled")):
        assert {r.status for r in out.detail.collect()} == {status} and out.keep.count() == 4 and out.remove.count() == 0


def test_dosages_of_rare_targets(spark):
    calls = spark.createDataFrame([(s, v, d) for v, ds in enumerate(([0.0, 1.0, 2.0, 0.05], [0.5, 0.5, 0.5, 0.6], [0.0, 0.0, 1.95, 0.0])) for s, d in enumerate(ds)], "sid long, vid long, g double")
    v = spark.createDataFrame([(i, "1", 10 + i, "A", "G") for i in range(3)], "vid long, chrom string, pos long, ref string, alt string")
    keep, bed = calls.select("sid").distinct(), spark.createDataFrame([("1", 0, 100)], "chrom string, start long, end long")
    hard = {r.vid: r.mac for r in pooled.rare_target(calls, v, keep, bed).collect()}
    assert hard == {0: 3.0, 2: 2.0}
    soft = {r.vid: (r.mac, r.r2) for r in pooled.rare_target(calls, v, keep, bed, mode="dosage", info_min=0.3).collect()}
    assert soft.keys() == {0, 2} and soft[2][0] == pytest.approx(1.95)
    with pytest.raises(ValueError, match="hardcall or dosage"):
        pooled.rare_target(calls, v, keep, bed, mode="both")


def test_tables_of_an_assignment(spark):
    rng = np.random.default_rng(11)
    centres = {"p1": ("A", 0, 0), "p2": ("A", 0, 8), "p3": ("B", 9, 0), "p4": ("C", 30, 30)}
    rows, sid = [], 0
    for name, (sup, a, b) in centres.items():
        for i in range(6 if name == "p2" else 30):
            far = 40 if name == "p1" and i == 0 else 0
            rows.append((sid, name, sup, float(a + rng.normal() + far), float(b + rng.normal())))
            sid += 1
    ref = spark.createDataFrame(rows, "sid long, population string, super_population string, pc1 double, pc2 double")
    study = spark.createDataFrame([(1000, 0.1, 0.2), (1001, 9.0, 0.5), (1002, 4.5, 0.1), (1003, 30.0, 30.0), (1004, -60.0, 0.0)], "sid long, pc1 double, pc2 double")
    out = ancestry.assignment(study, ref, ["pc1", "pc2"], ["A", "B"], min_n=20)
    models = {r.population: r for r in out.models.collect()}
    assert {p: (r.n_input, r.n_retained, r.n_outliers, r.model_status) for p, r in models.items()} == {"p1": (30, 29, 1, "retained"), "p2": (6, 6, 0, "dropped_low_reference_n"), "p3": (30, 30, 0, "retained"), "p4": (30, 30, 0, "retained")}
    assert models["p2"].assignment_cutoff is None and models["p1"].reference_outlier_cutoff > 0 and models["p1"].pc_count == 2
    assert [r.sid for r in out.outliers.collect()] == [0] and out.distances.count() == 15
    assert {r.sid: r.ancestry for r in out.assigned.collect()} == {1000: "A", 1001: "B"} == {r.sid: r.ancestry for r in out.within.collect()}
    reasons = {r.sid: r.reason for r in out.excluded.collect()}
    assert reasons.keys() == {1002, 1003, 1004} and reasons[1003] == "unconfigured_nearest_super_population" and reasons[1004] == "outside_reference_population_distance"
    counts = {(r.category, r.population, r.ancestry): r.n for r in out.counts.collect()}
    assert counts["assigned_population", "p1", "A"] == counts["assigned_ancestry", "ALL", "B"] == 1 and counts["excluded_total", "ALL", "ALL"] == 3


def test_traits_far_from_zero_keep_their_digits(spark):
    rng = np.random.default_rng(8)
    g, y = rng.integers(0, 3, 80), rng.normal(size=80)
    calls = spark.createDataFrame([(i, 0, int(x)) for i, x in enumerate(g)], "sid long, vid long, g int")
    fits = []
    for far in (0.0, 1e9):
        pheno = spark.createDataFrame([(i, float(v) + far) for i, v in enumerate(y)], "sid long, y double")
        fits.append(assoc.linear_assoc(calls, pheno).first())
    assert fits[1].beta == pytest.approx(fits[0].beta, rel=1e-5) and fits[1].se == pytest.approx(fits[0].se, rel=1e-5)


@pytest.mark.parametrize("binary", [False, True])
def test_wide_level1_is_solved_without_its_matrix(spark, monkeypatch, binary):
    """Neighbouring columns are nearly alike; conjugate gradients reach what the matrix of products gives."""
    from helixframe.operators import ridge

    rng = np.random.default_rng(41)
    n, width = 400, 45
    x = np.repeat(rng.normal(size=(n, width // 5)), 5, 1) + 0.1 * rng.normal(size=(n, width))
    y = x[:, 0] + rng.normal(size=n)
    y = (y > 0.3).astype(float) if binary else y
    fold = rng.integers(0, ridge.FOLDS, n)
    rows = [(list(range(a, a + 100)), fold[a : a + 100].tolist(), y[a : a + 100].tolist(), [0.0] * 100, x[a : a + 100].tobytes()) for a in range(0, n, 100)]
    design = spark.createDataFrame(rows, "sid array<long>, fold array<int>, y array<double>, offset array<double>, x binary")
    want = ridge.level1(design, width, ridge.SHARES, binary)
    monkeypatch.setattr(ridge, "DIRECT", 10)
    got = ridge.level1(design, width, ridge.SHARES, binary)
    assert got.share == want.share and np.allclose(got.weights, want.weights, atol=1e-7)


def _grouped(spark, groups, people, each, seed):
    """Calls in which every group of samples has variants of its own, (variants, pheno) beside them."""
    rng = np.random.default_rng(seed)
    n, m = groups * people, groups * each
    g = {(i, j): int(rng.integers(0, 3)) for i in range(n) for j in range(m) if i // people == j // each and rng.random() < 0.9}
    y = np.array([sum(g.get((i, j), 0) for j in range(m)) for i in range(n)]) + rng.normal(size=n)
    calls = spark.createDataFrame([(i, j, x) for (i, j), x in g.items()], "sid long, vid long, g int")
    v = spark.createDataFrame([(j, str(1 + j // each % 3), j) for j in range(m)], "vid long, chrom string, pos long")
    return calls, v, spark.createDataFrame([(i, float(y[i]), float(rng.normal())) for i in range(n)], "sid long, y double, x double")


@pytest.mark.parametrize("binary", [False, True])
def test_ridge_of_listed_calls_equals_that_of_tiles(spark, monkeypatch, binary):
    from helixframe.operators import ridge, tiles

    calls, v, pheno = _grouped(spark, 4, 30, 5, 51)
    if binary:
        pheno = pheno.withColumn("y", (F.col("y") > 4.5).cast("double"))
    got = []
    for least, places in ((0.0, 8192), (2.0, 7)):  # tiles; pieces, in small slices
        monkeypatch.setattr(tiles, "SPARSE", least)
        monkeypatch.setattr(ridge, "SLICE", places)
        monkeypatch.setattr(ridge, "PIECE", 40)
        found = ridge.fit_ridge_loco(calls, v, pheno, ["x"], block=4, shares=(0.2, 0.6), binary=binary).orderBy("sid", "chrom").collect()
        got.append(([(r.sid, r.chrom) for r in found], [r.pred for r in found]))
    assert len(got[0][0]) == 360 and got[0][0] == got[1][0] and np.allclose(got[0][1], got[1][1], atol=1e-7)
    twice = calls.unionByName(calls.limit(1))
    with pytest.raises(Exception, match="two calls of one variant"):
        ridge.fit_ridge_loco(twice, v, pheno, ["x"], block=4, binary=binary).collect()


def test_stored_tables_of_ridge_grow_with_the_calls(spark, monkeypatch):
    """A sample has 6 of 180 variants: no stored row is as wide as all variants, or all blocks."""
    from helixframe.operators import ridge

    calls, v, pheno = _grouped(spark, 30, 8, 6, 52)
    sizes = {}

    def kept(df, name, written=ridge.written, **more):
        out = written(df, name, **more)
        of = [c for c in ("tile", "z", "x") if c in out.columns and out.schema[c].dataType.typeName() == "binary"]
        if of:
            sizes[name] = out.agg(F.sum(F.length(of[0]))).first()[0]
        return out

    monkeypatch.setattr(ridge, "written", kept)
    assert ridge.fit_ridge_loco(calls, v, pheno, ["x"], block=6, shares=(0.2, 0.6)).count() == 240 * 3
    n = calls.count()
    assert sizes["pieces"] == 8 * n and sizes["design"] == sizes["level0"] <= 8 * n  # dense: 8 * 240 * 60 of the design
