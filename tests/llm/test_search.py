"""Near duplicates, top-k search, classifiers and the pipeline."""

import itertools
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helixframe.llm import graph, langid, quality, simhash, topk, toxicity
from helixframe.llm.common import crc_mod_py


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    texts = [None, "", "One", "one two", "A b c d e", "ä Ä x y z w v", "a b c " * 400]
    got = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.fingerprints(docs(spark, texts)).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(texts)}


def test_golay_code_is_perfect():
    index = simhash.golay_index(np.arange(1 << 23))
    assert np.bincount(index).tolist() == [2048] * 4096


def test_words_one_bit_apart_share_a_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for bits in itertools.combinations(range(0, 64, 7), 2):
        b = a ^ np.uint64(sum(1 << int(x) for x in bits))
        ka, ra = simhash.golay_keys(a)
        kb, rb = simhash.golay_keys(b)
        shared = {(k, r) for k, r in zip(ka.tolist(), ra.tolist(), strict=True)} & {(k, r) for k, r in zip(kb.tolist(), rb.tolist(), strict=True)}
        assert {r for _, r in shared} == set(range(len(a)))


def test_classes_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = [0, 0, *base.tolist()]
    for b in base[:25].tolist():  # chains, pairs and a crowd
        for _ in range(int(rng.integers(1, 6))):
            b ^= (1 << int(rng.integers(64))) | (1 << int(rng.integers(64)))
            fps.append(b)
    fps += [int(base[0]) ^ (1 << i) for i in range(64)] + [int(base[1])] * 30
    fps = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (int(fps[i]) ^ int(fps[j])).bit_count() <= 2 and (a := find(i)) != (b := find(j)):
            parent[max(a, b)] = min(a, b)
    prints = spark.createDataFrame([(i, int(x)) for i, x in enumerate(fps.view(np.int64))], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.classes(prints).collect()}
    assert got == {i: find(i) for i in range(len(fps))}
    assert simhash.classes(prints.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(0, 200).selectExpr("id as a", "id + 1 as b").unionByName(spark.createDataFrame([(-5, -4), (300, 300)], "a long, b long"))
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[-4] == -5


def test_near_copies_go(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(3000)]
    base = [" ".join(rng.choice(words, 300)) for _ in range(12)]
    near = base[0].split()
    near[100] = "changed"
    near[200] = "again"
    texts = [*base, " ".join(near), base[1], base[2].upper(), base[3] + " and more", None, "", None]
    got = {r.doc_id for r in simhash.drop_near_copies(docs(spark, texts).selectExpr("*", "'x' as fp", "1 as band")).collect()}
    assert got == {*range(12), 16}


def test_near_copies_beside_a_shared_passage(spark):
    passage = [f"p{i}" for i in range(404)]
    texts = [" ".join([*passage, *(f"own{i}x{j}" for j in range(56))]) for i in range(300)]  # 0.78 alike
    twins = [" ".join([*t.split()[:420], *(f"twin{i}x{j}" for j in range(40))]) for i, t in enumerate(texts[:150])]  # 0.838 like their own text only
    got = {r.doc_id for r in simhash.drop_near_copies(docs(spark, [*texts, *twins])).collect()}
    sets = [set(simhash.shingle_hashes(simhash.words_of(t), simhash.COPY_WORDS).tolist()) for t in [*texts, *twins]]
    near = {j for j in range(300, 450) if any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i in range(300))}
    assert len(near) == 150 and not got & near


def test_equal_fingerprints_of_different_texts_stay(spark):
    line = "the same line is said again and again until it fills most of the page "
    texts = [line * 40 + " ".join(f"own{i}x{j}" for j in range(60)) for i in range(12)]
    prints = [simhash.fingerprint(simhash.shingle_hashes(simhash.words_of(t), simhash.SHINGLE_WORDS)) for t in texts]
    assert sum((a ^ b).bit_count() <= simhash.MAX_BITS for a, b in itertools.combinations(prints, 2)) > 5
    near = " ".join([*texts[0].split()[:-1], "changed"])
    got = {r.doc_id for r in simhash.drop_near_copies(docs(spark, [*texts, near])).collect()}
    assert got == set(range(12))


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(400, 8)).astype(np.float32)
    v[200:300] = v[40]  # a hot vector: ties go to the smaller id
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(500, None), (520, [1.0] * 7 + [float("nan")]), (540, [1.0] * 7 + [None]), (560, []), (580, [float("inf")] * 8), (600, [1.0, 2.0]), (601, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "2 as q")
    got = {}
    for r in topk.top_k(df, lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    e = np.floor(64 * v.astype(np.float64)).astype(np.int64)
    for q in range(0, 400, 20):
        s = e @ e[q]
        want = sorted((i for i in range(400) if i != q), key=lambda i: (-s[i], i))[:20]
        assert [got[q][k + 1] for k in range(20)] == [(i, int(s[i])) for i in want]
    assert got[600] == {1: (601, 64 * 64 + 128 * 192)} and set(got) == {*range(0, 400, 20), 600}
    assert topk.top_k(df.limit(0), lambda c: c % 20 == 0).count() == 0


def test_huge_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [1e15, 3.0]), (1, [2.0, 1.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df, lambda c: c == 0).orderBy("rank").collect()]
    assert got == [(1, 64 * 10**15 * 128 + 192 * 64), (2, 64 * 10**15 * 128)]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(8)
    parts = {"aa": ["tion", "ing", "the", "er"], "bb": ["sch", "ung", "heit", "ver"]}
    rows = []
    for i in range(400):
        lang = "aa" if i % 2 else "bb"
        lines = [" ".join("".join(rng.choice(parts[lang], 3)) for _ in range(12)) for _ in range(6)]
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            lines[1:4] = [" ".join(w.upper() + "!!" for w in s.split()) for s in lines[1:4]]
        if toxic:
            lines[2] += " " + str(rng.choice(["vilest", "scoundrel", "vilely"]))
        rows.append((i, "\n".join(lines), lang, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int, toxic int")


def toxic_marks(labels):
    return labels.selectExpr("doc_id", "1 - quality as poor", "if(doc_id % 11 = 0, null, toxic * (1 - quality)) as poor_toxic", "toxic")


def test_languages(spark, corpus):
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, "12 %"), (1003, "tion " * 9)], "doc_id long, text string")
    model = langid.fit(corpus.filter("doc_id < 300"))
    truth = {r.doc_id: r.lang for r in corpus.collect()}
    assert all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in langid.identify(corpus, model).collect())
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in langid.identify(odd, model).collect()}
    assert got[1000] == got[1001] == got[1002] == ("und", True) and got[1003] == ("aa", False)
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(corpus.limit(0))).collect()} == {"und"}


def test_quality(spark, corpus):
    field = quality.fit(corpus, corpus.filter("doc_id < 300").select("doc_id", "quality"))
    truth = {r.doc_id: r.quality for r in corpus.filter("doc_id >= 300").collect()}
    got = quality.score(corpus.filter("doc_id >= 300"), field).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.95
    odd = quality.score(docs(spark, [None, "", "\n\n"]), field).collect()
    assert all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality.score(docs(spark, ["x"]), quality.fit(corpus, corpus.limit(0).select("doc_id", "quality"))).collect()} == {0.5}


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(9)
    unary, transition, counts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([4, 1, 4])
    got, _ = quality.marginals(unary, transition, counts)
    at = 0
    for n in counts:
        total, good = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(unary[at + i] * y for i, y in enumerate(labels)) + sum(transition[a, b] for a, b in itertools.pairwise(labels)))
            total += w
            good += w * np.array(labels)
        assert np.allclose(got[at : at + n], good / total)
        at += n


def test_toxicity(spark, corpus):
    chain = toxicity.fit(corpus, toxic_marks(corpus.filter("doc_id < 300")))
    truth = {r.doc_id: r.toxic for r in corpus.filter("doc_id >= 300").collect()}
    got = toxicity.score(corpus.filter("doc_id >= 300"), chain).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs(spark, [None, "", "x"]), chain).collect())
    assert toxicity.fit(corpus, toxic_marks(corpus.limit(0))) is None
    assert {r.score for r in toxicity.score(docs(spark, ["x"]), None).collect()} == {0.0}


def test_folds(spark):
    from helixframe.llm.common import crc_mod

    got = spark.range(0, 50).select("id", crc_mod("id", 4).alias("fold")).collect()
    assert all(r.fold == crc_mod_py(r.id, 4) for r in got)


def test_pipeline_runs(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and max(r.offset + r.length for r in rows) <= 4096


@pytest.mark.parametrize("size", [64, 65])
def test_keys_of_few_fingerprints_are_joined_and_larger_ones_spread(spark, size):
    """Fingerprints that share their two lower segments share a key: up to DIRECT of them are compared, more go through words one bit away."""
    top = np.random.default_rng(size).choice(1 << 12, size, replace=False)
    fps = [int(t) << 43 | 12345 for t in top]
    distinct = spark.createDataFrame([(f,) for f in fps], "fp long")
    keys = simhash.fuzzy_keys(distinct)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    assert shared.agg(F.max("n")).first()[0] == size and simhash.crowded(keys, shared).count() == (size if size > 64 else 0)
    root = {f: f for f in fps}
    for _ in fps:
        root = {f: min(root[g] for g in fps if (f ^ g).bit_count() <= 2) for f in fps}
    links = simhash.fingerprint_links(distinct)
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert {f: got.get(f, f) for f in fps} == root
    assert all((r.a ^ r.b).bit_count() <= 2 or size > 64 for r in links.collect())
