"""Odd rows through every operator and stage: nulls, shared keys, repeated rows, clashing names, empty tables; the registered queries by brute force."""

import itertools
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from helixframe.llm import langid, lexicon, licenses, media, packing, passages, quality, queries, simhash, topk, toxicity
from helixframe.llm.common import draw_labelled, keep, scratch, shared_dir

BYTES = __import__("public_tokenizers").path("byte_bpe_50k.json")
SENTENCES = [f"The {a} {b} went to the {c} and found nothing there at all." for a, b, c in itertools.product(("old", "new", "red"), ("man", "dog", "ship"), ("town", "lake", "hill"))]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, removed string, file long, at int, docs int, row int, fp long, score double, y int, __rank int"


def table(spark, rows):
    """documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "r", 5, 6, 7, 8, 9, 0.5, 1, 2) for i, t in rows], SCHEMA)


ODD = [
    (1, SENTENCES[0] + " " + SENTENCES[1]), (1, SENTENCES[0] + " Only here, in the second row of that key, stands this."), (2, None), (None, SENTENCES[0] + " " + SENTENCES[1]),
    (None, " ".join(SENTENCES)), (3, ""), (4, " ".join(SENTENCES[:9])), (4, " ".join(SENTENCES[:9])), (5, " ".join(SENTENCES[:9]) + " Last."), (6, "\n\n"), (7, "!" * 50),
]


def test_rows_that_share_a_key_are_cut_alone(spark):
    d = table(spark, ODD)
    got = passages.remove_repeats(keep(d, "odd"), stored=True).collect()
    texts = sorted(r.text for r in got if r.doc_id == 1)
    assert len(got) == len(ODD) and sum(r.text is None for r in got) == 1
    assert texts[-1] == SENTENCES[0] + " " + SENTENCES[1] or texts[0].endswith("stands this.")
    assert any("stands this." in t for t in texts)  # the other row's sentence of its own stays
    assert sorted(r.text or "" for r in got if r.doc_id == 4)[0] == ""  # the second of equal rows is all repeats
    assert [r.text for r in got if r.doc_id is None and "red ship" in r.text] != []
    assert all(r.row == 8 and r.file == 5 for r in got)
    again = corpus_pipeline.substring_dedup(spark, keep(d, "odd"), "")
    assert again.columns == d.columns and {r.removed for r in again.collect()} == {"r"}
    assert all(r.n_chars == len(r.text) for r in again.collect())


def test_passages_without_a_limit_remove_every_repeat(spark):
    d = spark.createDataFrame([(0, "one two.\nthree"), (1, "three\nfour")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in passages.remove_repeats(d, min_words=0).collect()} == {0: "one two.\nthree", 1: "four"}


def test_near_copies_by_row(spark):
    d = keep(table(spark, ODD), "odd")
    got = corpus_pipeline.near_dedup(spark, d, "").collect()
    texts = [r.text for r in got]
    assert got[0].asDict().keys() == dict.fromkeys(d.columns).keys()
    # one row of each text stays; the copy without a key goes, the null-keyed text of its own stays, and of the near copies 4 and 5 the first
    assert sorted(t or "" for t in texts) == sorted(["", SENTENCES[0] + " " + SENTENCES[1], ODD[1][1], " ".join(SENTENCES), " ".join(SENTENCES[:9]), "!" * 50])
    assert {r.doc_id for r in got if r.text == SENTENCES[0] + " " + SENTENCES[1]} == {1}
    assert [r.doc_id for r in got if r.text == " ".join(SENTENCES)] == [None]


def test_near_copies_in_a_group_larger_than_a_tile(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(3 * simhash.TILE):
        words = list(base)
        words[int(rng.integers(400))] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got] == [0]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_and_odd_tables(spark, stage):
    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("needs the given tables")
    for rows in ([], ODD):
        d = keep(table(spark, rows), "odd")
        out = stage(spark, d, sf)
        found = out.collect()
        assert len(found) <= len(rows)
        if "sequence_id" not in out.columns:
            assert out.columns == d.columns
        elif rows:
            assert len(found) == len(rows)


def test_operators_take_clashing_names_and_empty_tables(spark):
    d, none = table(spark, ODD), table(spark, [])
    labels = spark.createDataFrame([(1, 0, 1), (3, 1, 0), (4, 1, None), (None, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    for t, n in ((d, len(ODD)), (none, 0)):
        assert toxicity.score(t, toxicity.fit(t, toxicity._marks(labels))).count() == n
        assert quality.score(t, quality.fit(t, labels)).count() == n
        assert langid.identify(t, langid.fit(t)).count() == n
        assert lexicon.round_trip(t, BYTES, lexicon.build_lexicon(t, BYTES)).count() == n
        assert media.payload_features(media.store_texts(t)).count() == n
        assert licenses.scan(t).count() == n
        assert passages.remove_repeats(t).count() == n
        pieces = keep(packing.pieces(t, __import__("public_tokenizers").path("word_bpe_49k.json")), "pieces")
        assert packing.pack(pieces, pieces.count()).count() == n
        assert simhash.classes(keep(simhash.fingerprints(t), "prints")).count() == n


def test_very_long_texts(spark):
    long = " ".join(f"w{i % 5000}" for i in range(120_000)) + "\n" + "x " * 50_000 + "\n" * 30_000
    d = spark.createDataFrame([(1, long), (2, "short"), (3, long)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    assert quality.score(d, quality.fit(d, labels)).count() == 3
    assert [r.doc_id for r in simhash.drop_near_copies(d).collect()] == [1, 2] or {r.doc_id for r in simhash.drop_near_copies(d).collect()} == {1, 2}
    prints = {r.doc_id: r.fp for r in simhash.fingerprints(d).collect()}
    assert prints[1] == prints[3]
    got = {r.doc_id: r.text for r in passages.remove_repeats(d).collect()}
    assert len(got[1]) <= len(long) and got[3].strip() == "" and got[2] == "short"
    assert {r.doc_id for r in licenses.scan(d).collect()} == {1, 2, 3}
    assert langid.identify(d, langid.fit(d.selectExpr("*", "'en' as lang"))).count() == 3


def test_malformed_images_are_bad(spark):
    bad = [
        b"P2\n1 1\n255\n99999999999999999999999", b"P6\n99999999999999999999 1\n255\nx", b"P2\n1 1\n255\n-5", b"P5\n1000000 1000000\n255\nx", b"P3\n1 1\n255\n1 2", b"P1\n2 2\n1", b"P4\n64 64\n\0",
        b"BM" + b"\0" * 20, b"BM" + b"\0" * 36, b"BM" + b"\xff" * 60, b"P5\n1 1\n0\nx", b"P7\n1 1\n", b"P2\n1 1\n255\nx", b"P5\n1 1\n70000\nxx",
    ]
    got = {r.doc_id: r.status for r in media.tiles(spark.createDataFrame(list(enumerate(bad)), "doc_id long, media binary")).collect()}
    assert got == dict.fromkeys(range(len(bad)), "bad")


def test_difference_hash_by_hand():
    image = np.zeros((8, 9, 1), np.uint8)
    image[:, :, 0] = np.arange(9) * 10
    assert media.difference_hash(image) == "ff" * 8
    assert media.difference_hash(image[:, ::-1]) == "00" * 8


def test_a_hint_may_be_wrapped(spark):
    texts = ["This is free and unencumbered software released into the public\ndomain.", "Licensed under the\nMIT\tlicense."]
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: ["Unlicense"], 1: ["MIT-named"]}


def test_draw_is_bounded_and_by_class(spark):
    docs = spark.range(0, 1000).withColumnRenamed("id", "doc_id")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as y").unionByName(docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as y"))
    got = draw_labelled(docs.filter("doc_id < 900"), labels, "doc_id", "y", 50).collect()
    assert len(got) == len({r.doc_id for r in got}) == 100 and sum(r.y for r in got) == 50 and max(r.doc_id for r in got) < 900
    best = sorted(r.draw for r in got if r.y == 1)
    every = sorted(r.draw for r in draw_labelled(docs.filter("doc_id < 900"), labels, "doc_id", "y", 10_000).collect() if r.y == 1)
    assert best == every[:50]


def test_chain_gives_later_models_out_of_fold_inputs():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (200, 3)).astype(np.float32)
    a = x[:, 0].astype(float)
    y = {"a": a, "b": np.where(rng.random(200) < 0.1, np.nan, a)}
    folds, every = np.arange(200) % toxicity.FOLDS, np.arange(3)
    chosen = {(c, k): every if c == "a" else np.array([1, 2]) for c in y for k in range(-1, toxicity.FOLDS)}
    chain = toxicity.Chain(x, y, folds, chosen)
    first = chain.predict(x)[:, 0]
    out = np.empty(200)
    for k in range(toxicity.FOLDS):
        out[folds == k] = toxicity.Linear(x[folds != k], a[folds != k]).predict(x[folds == k])
    known = ~np.isnan(y["b"])
    want = toxicity.Linear(np.hstack([x[:, 1:], out[:, None]])[known], y["b"][known])
    assert np.allclose(want.weights, chain.models[1].weights, atol=1e-5)
    assert np.allclose(chain.predict(x)[:, 1], want.predict(np.hstack([x[:, 1:], first[:, None]])), atol=1e-5)


def test_features_are_chosen_without_the_fold_left_out(spark):
    rows = [(k % toxicity.FOLDS, int(k % 2), ["=good"] if k % 2 == 0 else ["=bad"] if k % toxicity.FOLDS else ["=leak"]) for k in range(100)]
    chosen = toxicity.select_features(spark.createDataFrame(rows, "fold int, t int, found array<string>"), ["t"], 10)
    assert "=leak" in chosen["t", -1] and "=leak" not in chosen["t", 0] and {"=good", "=bad"} <= set(chosen["t", 0])


def brute_bins(lengths, capacity):
    """The fewest bins, by search."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= lengths[i]:
                place(i + 1, [*rooms[:j], room - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_packing_is_near_the_fewest_bins():
    rng = np.random.default_rng(6)
    for _ in range(30):
        lengths = sorted(rng.integers(1, 30, 9).tolist(), reverse=True)
        assert len(packing.best_two_fit(np.array(lengths), 30)) <= brute_bins(lengths, 30) + 1


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """A folder of tables of a few hundred documents."""
    sf = Path("/root/testdata/sf0.001")
    if not sf.exists():
        pytest.skip("needs the given tables")
    out = tmp_path_factory.mktemp("small")
    docs = pd.read_parquet(sf / "documents.parquet")
    docs.to_parquet(out / "documents.parquet")
    pd.read_parquet(sf / "labels.parquet").to_parquet(out / "labels.parquet")
    pd.read_parquet(sf / "embeddings.parquet").head(300).to_parquet(out / "embeddings.parquet")
    return str(out), docs


def test_registered_queries_keep_their_contracts(spark, small):
    path, docs = small
    text = docs.set_index("doc_id").text.fillna("").to_dict()
    for name, f in queries.QUERIES.items():
        got = f(spark, path).toPandas()
        if name.startswith(("op9", "op12")):  # not rows of documents; see test_contracts
            continue
        assert set(got.doc_id) == set(text), name
        if name.startswith("op7"):
            assert (got.groupby("sequence_id").length.sum() <= 4096).all()
            continue
        assert len(got) == len(docs), name
        if "held_out" in got:
            mod, rest = (4, 2) if name.startswith("op4") else (3, 1)
            assert all(bool(h) == (zlib.crc32(str(i).encode()) % mod == rest) for i, h in zip(got.doc_id, got.held_out, strict=True))
            assert got.score.between(0, 1).all()
        if name.startswith("op8"):
            prints = {i: simhash.fingerprint(simhash.shingle_hashes(simhash.words_of(t), 3)) & (1 << 64) - 1 for i, t in text.items()}
            assert all(prints[i] == int(p, 16) for i, p in zip(got.doc_id, got.fingerprint, strict=True))
            ids = list(prints)
            parent = {i: i for i in ids}

            def find(i):
                while parent[i] != i:
                    i = parent[i]
                return i

            for a, b in itertools.combinations(ids, 2):
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
            assert all(find(i) == c for i, c in zip(got.doc_id, got.component_id, strict=True))


def test_labels_of_held_out_rows_are_not_used(spark, small, tmp_path):
    path, docs = small
    labels = pd.read_parquet(path + "/labels.parquet")
    held = labels.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    labels.loc[held, ["quality", "toxic"]] = 1 - labels.loc[held, ["quality", "toxic"]]
    docs.to_parquet(tmp_path / "documents.parquet")
    labels.to_parquet(tmp_path / "labels.parquet")
    other = docs.copy()
    for name in ("op1_toxicity_chain", "op10_quality_lines"):
        a, b = (queries.QUERIES[name](spark, p).toPandas().sort_values("doc_id").score.to_numpy() for p in (path, str(tmp_path)))
        assert np.allclose(a, b)
    rest = other.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    other.loc[rest, "lang"] = "xx"
    other.to_parquet(tmp_path / "documents.parquet")
    a, b = (queries.QUERIES["op4_language_id"](spark, p).toPandas().sort_values("doc_id").lang_pred.tolist() for p in (path, str(tmp_path)))
    assert a == b


def test_scratch_deletes_what_was_kept(spark):
    with scratch(spark):
        t = keep(spark.range(3), "gone")
        held = keep(t, "held", hold=True)
    assert held.count() == 3 and not list(Path(shared_dir(spark).removeprefix("file:")).glob("gone-*"))


def test_top_k_takes_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []), (6, [3.0, 4.0]), (None, [9.0, 9.0]), (6, [3.0, 4.0]), (7, [1.0])]
    d = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, q int, cutoff int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(d, lambda c: c == 0).collect())
    score = 64 * 64 * 11
    assert got == [(0, 1, 6, score), (0, 2, 6, score)]


def test_licences_come_by_precedence(spark):
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND\nFITNESS."
    agpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU Affero General Public License for more details."
    both = "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame([(0, isc), (1, agpl), (2, both)], "doc_id long, text string")).collect()}
    assert got == {0: ["ISC"], 1: ["AGPL-3.0-or-later"], 2: ["Apache-2.0", "MIT"]}
