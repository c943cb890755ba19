"""Tiles of genotypes, what is multiplied on them, pruning by windows, and the BED source."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import genotype, pruning, tiles
from helixframe.sources import bed


def cohort(spark, n: int, m: int, seed: int = 1, missing: float = 0.1, chroms: int = 2):
    """(calls, variants, matrix with NaN): neighbours are alike, so many pairs are in conflict."""
    rng = np.random.default_rng(seed)
    g = np.empty((m, n))
    for v in range(m):
        fresh = rng.binomial(2, rng.uniform(0.1, 0.5), n)
        g[v] = fresh if v == 0 else np.where(rng.random(n) < 0.75, g[v - 1], fresh)
    g[rng.random((m, n)) < missing] = np.nan
    rows = [(int(s), int(v), None if np.isnan(g[v, s]) else int(g[v, s])) for v in range(m) for s in range(n)]
    calls = spark.createDataFrame(rows, "sid long, vid long, g int")
    variants = spark.createDataFrame([(v, str(1 + v * chroms // m), 100 + 7 * v) for v in range(m)], "vid long, chrom string, pos long")
    return calls, variants, g


def r2_of(x: np.ndarray, y: np.ndarray) -> float:
    both = ~np.isnan(x) & ~np.isnan(y)
    x, y = x[both], y[both]
    return float(np.corrcoef(x, y)[0, 1] ** 2) if len(x) > 1 and x.std() > 0 and y.std() > 0 else float("nan")


def test_packed_calls_come_back():
    rng = np.random.default_rng(0)
    code = rng.integers(0, 4, (tiles.VARIANTS, tiles.SAMPLES))
    g, known = tiles.unpack(tiles.pack(code))
    assert (known == (code != 3)).all() and (g == np.where(code == 3, 0, code)).all() and len(tiles.pack(code)) == code.size // 4


def test_products_of_tiles_equal_plain_sums(spark, monkeypatch):
    calls, variants, g = cohort(spark, 60, 300)
    t = tiles.tiled(calls, variants)
    assert t.tiles.count() == 4  # two chromosomes of 150 variants, blocks of 128
    pairs = spark.createDataFrame([(a, b) for a in range(0, 300, 7) for b in range(a, min(a + 140, 300), 13)], "a long, b long")
    got = {(r.a, r.b): (r.n, r.r2) for r in tiles.pair_r2(t, pairs).collect()}
    for (a, b), (n, r2) in got.items():
        assert n == int((~np.isnan(g[a]) & ~np.isnan(g[b])).sum()) and r2 == pytest.approx(r2_of(g[a], g[b]), abs=1e-9)
    assert len(got) == pairs.count()
    for r in tiles.kinship(t).collect():
        x, y = g[:, r.a], g[:, r.b]
        both = ~np.isnan(x) & ~np.isnan(y)
        x, y = x[both], y[both]
        het_a, het_b, hethet, ibs0 = (x == 1).sum(), (y == 1).sum(), ((x == 1) & (y == 1)).sum(), (abs(x - y) == 2).sum()
        low = min(het_a, het_b)
        assert (r.n, r.het_a, r.het_b, r.hethet, r.ibs0) == (both.sum(), het_a, het_b, hethet, ibs0)
        assert r.phi == pytest.approx((hethet - 2 * ibs0) / (2 * low) + 0.5 - (het_a + het_b) / (4 * low))


def test_many_sample_blocks(spark):
    """More samples than a tile has: sums run over sample blocks, pairs over pairs of them."""
    n, m = tiles.SAMPLES + 40, 6
    g = np.random.default_rng(3).integers(0, 3, (m, n))
    calls = spark.createDataFrame([(s, v, int(g[v, s])) for v in range(m) for s in range(n)], "sid long, vid long, g int")
    t = tiles.tiled(calls)
    got = {(r.a, r.b): r.r2 for r in tiles.pair_r2(t, spark.createDataFrame([(0, 1), (2, 5)], "a long, b long")).collect()}
    assert got == {(a, b): pytest.approx(r2_of(g[a].astype(float), g[b].astype(float))) for a, b in ((0, 1), (2, 5))}
    kin = tiles.kinship(t, above=-100.0)
    assert kin.select("a", "b").distinct().count() == kin.count() and kin.filter("a >= b").isEmpty()
    r = kin.filter(f"a = 3 and b = {n - 1}").first()
    assert r.ibs0 == int((abs(g[:, 3] - g[:, n - 1]) == 2).sum())


def test_dosages_keep_their_values_and_hard_calls_are_checked(spark):
    d = np.random.default_rng(4).uniform(0, 2, (5, 50))
    calls = spark.createDataFrame([(s, v, float(d[v, s])) for v in range(5) for s in range(50)], "sid long, vid long, g double")
    t = tiles.tiled(calls)
    r = tiles.pair_r2(t, spark.createDataFrame([(1, 4)], "a long, b long")).first()
    assert r.r2 == pytest.approx(r2_of(d[1], d[4]), abs=1e-5)
    with pytest.raises(ValueError, match="hard calls"):
        tiles.kinship(t)
    for rows in ([(0, 0, 5)], [(0, 0, 1), (0, 0, 1)]):
        with pytest.raises(Exception, match="hard calls are|two calls"):
            tiles.tiled(spark.createDataFrame(rows, "sid long, vid long, g int"))


def removal(pairs: list[tuple], maf: np.ndarray) -> set[int]:
    gone: set[int] = set()
    for _, i, j in sorted(pairs):
        if i not in gone and j not in gone:
            gone.add(i if maf[i] < maf[j] else j)
    return gone


@pytest.mark.parametrize(("window", "step"), [(20, 5), (50, 10), (150, 150), (7, 1)])
def test_pruning_by_counted_windows_equals_plain_removal(spark, window, step):
    calls, variants, g = cohort(spark, 40, 420, seed=window, chroms=2)
    t, freq = tiles.tiled(calls, variants), genotype.allele_counts(calls)
    left = {r.vid for r in pruning.prune_windows(t, freq, window, step, 0.2, stretch=window).collect()}
    maf = {r.vid: r.maf for r in freq.collect()}
    want = set(range(420))
    for first in (0, 210):
        pairs = []
        begin = 0
        while begin < 210:
            pairs += [(begin, first + i, first + j) for i in range(begin, min(begin + window, 210)) for j in range(i + 1, min(begin + window, 210))]
            begin += step
        near = [p for p in pairs if r2_of(g[p[1]], g[p[2]]) > 0.2]
        want -= removal(near, maf)
    assert left == want and 0 < len(left) < 420


def test_few_variants_left_are_an_error(spark):
    calls, variants, _ = cohort(spark, 30, 60)
    with pytest.raises(ValueError, match="at least 60"):
        pruning.prune_windows(tiles.tiled(calls, variants), genotype.allele_counts(calls), 50, 10, 0.1, minimum=60)


def test_pruning_by_distance_equals_plain_removal(spark):
    calls, variants, g = cohort(spark, 40, 300, seed=9, chroms=1)
    maf = {r.vid: r.maf for r in genotype.allele_counts(calls).collect()}
    left = {r.vid for r in genotype.ld_prune(calls, variants, 70, 0.2).collect()}
    near = [(0, i, j) for i in range(300) for j in range(i + 1, min(i + 11, 300)) if r2_of(g[i], g[j]) > 0.2]
    assert left == set(range(300)) - removal(near, maf)


def test_long_chains_settle(spark):
    """Each variant is in conflict with the next alone: what happens at the end depends on the begin."""
    rows = [("1", i, i, i, i + 1, i, i + 1, i + 1 if i % 3 else i) for i in range(200)]
    conflicts = spark.createDataFrame(rows, "chrom string, start long, k long, i long, j long, ai long, aj long, gone long")
    got = {r.id for r in pruning.settle(conflicts, 10).collect()}
    gone: set[int] = set()
    for _, _, _, i, j, _, _, g in rows:
        if i not in gone and j not in gone:
            gone.add(g)
    assert got == gone


def bed_file(folder, g: np.ndarray) -> str:
    """A BED file, and its two companions, of a matrix of variants by samples with -1 for no call."""
    m, n = g.shape
    code = np.array([3, 2, 0, 1], np.uint8)[g]  # of 0, 1, 2 and -1
    code = np.hstack([code, np.zeros((m, -n % 4), np.uint8)]).reshape(m, -1, 4)
    (folder / "x.bed").write_bytes(bed.MAGIC + (code[:, :, 0] | code[:, :, 1] << 2 | code[:, :, 2] << 4 | code[:, :, 3] << 6).astype(np.uint8).tobytes())
    (folder / "x.fam").write_text("f i 0 0 0 0\n" * n)
    (folder / "x.bim").write_text("1 v 0 1 A G\n" * m)
    return str(folder / "x")


@pytest.mark.parametrize("n", [4, 5, 1023, 1024, 1026, 2050])
def test_bed_ranges_hold_every_call(spark, tmp_path, n):
    g = np.random.default_rng(n).integers(-1, 3, (37, n))
    at = bed_file(tmp_path, g)
    rows = bed.read_bed(spark, at, range_bytes=5 * ((n + 3) // 4))
    assert rows.rdd.getNumPartitions() == 8  # 37 variants, five a range
    got = rows.toPandas()
    assert len(got) == 37 * n and (got.g.fillna(-1).astype(int).to_numpy() == g[got.vid, got.sid]).all()


def test_tiles_of_strips_equal_tiles_of_calls(spark, tmp_path):
    g = np.random.default_rng(8).integers(-1, 3, (300, 1100))
    at = bed_file(tmp_path, g)
    variants = spark.createDataFrame([(v, str(1 + v // 140), (v * 7919) % 1000) for v in range(300)], "vid long, chrom string, pos long")
    a, b = bed.read_tiles(spark, at, variants, range_bytes=4000), tiles.tiled(bed.read_bed(spark, at), variants)
    one, other = ({(r.block, r.sblock): (bytes(r.tile), list(r.vids)) for r in t.tiles.collect()} for t in (a, b))
    assert one.keys() == other.keys() and all(one[k][0] == other[k][0] for k in one)
    pairs = spark.createDataFrame([(0, 1), (5, 120), (150, 151)], "a long, b long")
    x, y = (sorted(map(tuple, tiles.pair_r2(t, pairs).collect())) for t in (a, b))
    assert x == y and len(x) == 3


def test_a_large_bed_file_has_many_ranges(tmp_path):
    """3 GB, of which nothing is written but the begin."""
    n, m = 400_000, 30_000
    with open(tmp_path / "x.bed", "wb") as f:
        f.write(bed.MAGIC)
        f.truncate(3 + n // 4 * m)
    reader = bed.BedReader(str(tmp_path / "x.bed"), n, m, bed.RANGE_BYTES)
    parts = reader.partitions()
    assert len(parts) > 80 and sum(p.variants for p in parts) == m and max(p.variants for p in parts) * n // 4 <= bed.RANGE_BYTES
    last = next(reader.read(bed.Range(m - 1, 1)))
    assert last.num_rows == -(-n // tiles.SAMPLES) and last.column(0)[0].as_py() == m - 1
    with pytest.raises(ValueError, match="BED"):
        bed.BedReader(str(tmp_path / "x.bed"), n, m + 1, bed.RANGE_BYTES).check()


def newton_of_one(x, y, firth, rounds=60):
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        mu = 1 / (1 + np.exp(-x @ w))
        v = mu * (1 - mu)
        inverse = np.linalg.inv((x * v[:, None]).T @ x)
        left = y - mu + (v * np.einsum("ij,jk,ik->i", x, inverse, x) * (0.5 - mu) if firth else 0)
        step = np.clip(inverse @ (x.T @ left), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-9:
            return w[-1], np.sqrt(inverse[-1, -1])
    return None


def test_logistic_fits_of_a_tile_equal_those_of_single_variants(spark):
    from helixframe.operators import assoc

    calls, variants, g = cohort(spark, 150, 40, seed=12)
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=150), (rng.random(150) < 0.4).astype(float)
    g[7] = np.where(np.isnan(g[7]), np.nan, 0)  # no variance: fails
    g[8] = np.where(rng.random(150) < 0.1, np.nan, 0)
    g[8][np.flatnonzero((y == 1) & ~np.isnan(g[8]))[:4]] = 1  # cases alone carry it: Firth
    rows = [(s, v, None if np.isnan(g[v, s]) else int(g[v, s])) for v in range(40) for s in range(150)]
    calls = spark.createDataFrame(rows, "sid long, vid long, g int")
    pheno = spark.createDataFrame([(i, float(y[i]), float(x[i]) if i % 11 else None) for i in range(150)], "sid long, y double, x double")
    got = {r.vid: r for r in assoc.logistic_assoc(tiles.tiled(calls, variants), pheno, ["x"]).collect()}
    assert len(got) == 40 and got[7].method == "failed" and got[8].method == "firth"
    for v in set(range(40)) - {7}:
        use = ~np.isnan(g[v]) & (np.arange(150) % 11 != 0)
        beta, se = newton_of_one(np.column_stack([np.ones(use.sum()), x[use], g[v][use]]), y[use], v == 8)
        assert got[v].n == use.sum() and got[v].beta == pytest.approx(beta, abs=1e-7) and got[v].se == pytest.approx(se, rel=1e-6)
        assert got[v].method == ("firth" if v == 8 else "irls")


def test_admixture_equals_numpy_and_rises(spark):
    from helixframe.operators import admixture

    rng = np.random.default_rng(6)
    n, m, names = 90, 200, ["AFR", "EAS", "EUR"]
    p = rng.uniform(0.05, 0.95, (m, 3))
    q = np.vstack([np.repeat(np.eye(3), 15, 0), rng.dirichlet(np.ones(3), n - 45)])
    g = rng.binomial(2, np.clip(p @ q.T, 0, 1)).astype(float)
    g[rng.random(g.shape) < 0.1] = np.nan
    calls = spark.createDataFrame([(s, v, None if np.isnan(g[v, s]) else int(g[v, s])) for v in range(m) for s in range(n)], "sid long, vid long, g int")
    labels = spark.createDataFrame([(i, names[i // 15]) for i in range(45)], "sid long, label string")
    t = tiles.tiled(calls, spark.createDataFrame([(v, "1", v) for v in range(m)], "vid long, chrom string, pos long"))
    out = admixture.fit(t, labels, rounds=12, tolerance=0)
    known, x = (~np.isnan(g)).astype(float), np.nan_to_num(g)
    own = np.vstack([np.repeat(np.eye(3), 15, 0), np.zeros((45, 3))])
    a = np.clip(x @ own / (2 * known @ own), 1e-5, 1 - 1e-5)
    b = np.vstack([own[:45], np.full((45, 3), 1 / 3)])
    levels = []
    for i in range(12):
        one, none = a @ b.T, (1 - a) @ b.T
        levels.append((known * (x * np.log(one) + (2 - x) * np.log(none))).sum())
        high, low = known * x / one, known * (2 - x) / none
        up, down = a * (high @ b), (1 - a) * (low @ b)
        new = b * (high.T @ a + low.T @ (1 - a)) / (2 * known.sum(0))[:, None]
        a = np.clip(up / (up + down), 1e-5, 1 - 1e-5)
        b = np.vstack([b[:45], new[45:]])
    assert np.allclose(out.likelihoods, levels, rtol=1e-9) and (np.diff(levels) > 0).all()
    got = {(r.sid, r.label): r.q for r in out.proportions.collect()}
    assert len(got) == 3 * n and all(got[s, names[c]] == pytest.approx(b[s, c], abs=1e-9) for s in range(n) for c in range(3))
    freq = {(r.vid, r.label): r.p for r in out.frequencies.collect()}
    assert all(freq[v, names[c]] == pytest.approx(a[v, c], abs=1e-9) for v in range(m) for c in range(3))
    assert np.abs(b[45:] - q[45:]).mean() < 0.08


def test_listed_calls_give_what_tiles_give(spark):
    """Few calls are listed, four bytes each, whatever samples times variants are; every step has the same result."""
    from helixframe.operators import admixture, assoc

    rng = np.random.default_rng(21)
    n, m = 2100, 150
    at = np.flatnonzero(rng.random(n * m) < 0.03)
    g = rng.binomial(2, 0.4, len(at))
    calls = spark.createDataFrame([(int(x // m), int(x % m), int(c)) for x, c in zip(at, g, strict=True)], "sid long, vid long, g int")
    variants = spark.createDataFrame([(v, "1", 7 * v) for v in range(m)], "vid long, chrom string, pos long")
    few, full = tiles.tiled(calls, variants), tiles.tiled(calls, variants, listing=False)
    assert few.sparse and not full.sparse and sum(len(r.tile) for r in few.tiles.collect()) == 4 * len(at)
    pairs = spark.createDataFrame([(a, b) for a in range(m) for b in range(a, m)], "a long, b long")
    pheno = spark.createDataFrame([(s, float(rng.random() < 0.4), float(rng.normal()) if s % 9 else None) for s in range(n)], "sid long, y double, x double")
    labels = spark.createDataFrame([(s, "ABC"[s % 3]) for s in range(0, n, 2)], "sid long, label string")

    def same(run, keys: int) -> None:
        one, other = ({tuple(r)[:keys]: tuple(r)[keys:] for r in run(t).collect()} for t in (few, full))
        assert one.keys() == other.keys() and one
        for k, row in one.items():
            for x, y in zip(row, other[k], strict=True):
                assert x == (pytest.approx(y, rel=1e-6, abs=1e-9) if isinstance(y, float) else y)

    same(lambda t: tiles.pair_r2(t, pairs), 2)
    same(lambda t: tiles.window_r2(t, 30, 7, 0.01).select("a", "b", "n", "r"), 2)
    same(lambda t: tiles.kinship(t, 0.2), 2)
    same(lambda t: assoc.logistic_assoc(t, pheno, ["x"]), 1)
    same(lambda t: admixture.fit(t, labels, rounds=3).proportions, 2)
    with pytest.raises(Exception, match="two calls"):
        tiles.tiled(calls.unionByName(calls.limit(1)), variants)


@pytest.mark.parametrize("listing", [False, True])
def test_newton_steps_reach_what_long_em_reaches(spark, monkeypatch, listing):
    from helixframe.operators import admixture

    rng = np.random.default_rng(14)
    n, m = 60, 80
    p = rng.uniform(0.1, 0.9, (m, 2))
    q = np.vstack([np.repeat(np.eye(2), 15, 0), rng.dirichlet(np.ones(2), n - 30)])
    g = rng.binomial(2, p @ q.T)
    calls = spark.createDataFrame([(s, v, int(g[v, s])) for v in range(m) for s in range(n) if (s + v) % 5], "sid long, vid long, g int")
    labels = spark.createDataFrame([(i, "AB"[i // 15]) for i in range(30)], "sid long, label string")
    monkeypatch.setattr(tiles, "SPARSE", 2.0 if listing else 0.0)
    t = tiles.tiled(calls)
    out = admixture.fit(t, labels, rounds=None, tolerance=1e-8)
    known = np.array([[float((s + v) % 5 > 0) for s in range(n)] for v in range(m)])
    own = np.vstack([np.repeat(np.eye(2), 15, 0), np.zeros((30, 2))])
    a, b, x = np.clip(known * g @ own / (2 * known @ own), 1e-5, 1 - 1e-5), np.vstack([own[:30], np.full((30, 2), 0.5)]), known * g
    for _ in range(20000):
        one, none = a @ b.T, (1 - a) @ b.T
        level = (known * (x * np.log(one) + (2 - x) * np.log(none))).sum()
        high, low = x / one, known * (2 - x) / none
        up, down = a * (high @ b), (1 - a) * (low @ b)
        b = np.vstack([b[:30], (b * (high.T @ a + low.T @ (1 - a)) / (2 * known.sum(0))[:, None])[30:]])
        a = np.clip(up / (up + down), 1e-5, 1 - 1e-5)
    assert t.sparse == listing and (np.diff(out.likelihoods) >= 0).all() and out.likelihoods[-1] == pytest.approx(level, abs=0.01)
    got = {(r.sid, r.label): r.q for r in out.proportions.collect()}
    assert all(got[s, "AB"[c]] == pytest.approx(b[s, c], abs=0.01) for s in range(n) for c in range(2))


def test_the_admixture_query_bounds_no_rounds(spark, monkeypatch):
    from helixframe import catalog
    from helixframe.operators import admixture

    seen, none = [], spark.createDataFrame([], "sid long, label string, q double")
    monkeypatch.setattr(admixture, "fit", lambda t, labels, **more: seen.append(more) or admixture.Admixture(none, none, []))
    assert catalog.QUERIES["supervised_admixture"](spark, "/root/testdata/sf0.001").count() == 0
    assert seen == [{"rounds": None}]
