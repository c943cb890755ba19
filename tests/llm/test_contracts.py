"""Operators 11 to 13 and the contracts of registered queries, held against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helixframe.llm import langid, merkle, packing, permuterm, queries, simhash, thresholds, toxicity
from helixframe.llm.common import shared_dir

TOKENIZERS = __import__("public_tokenizers")
ROWS = [
    (3, "One two three one two three. " * 30, "en"), (1, None, "fr"), (3, "One two three one two three. " * 30, "en"), (2, "", None), (None, "Ünïcode and UPPER Words #1 & <tags>\n\na line\na line\n", None),
    (7, "a b c d " * 20 + "\n\x0b\x1c\n", "de"), (8, "Straße ÉTÉ été " * 40, "de"), (None, None, "de"), (-5, "x" * 300, "en"), (3, "another text of that id", "en"), (11, "\n".join(f"word{i} and some more words here" for i in range(30)), "en"),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder of tables of odd rows, in two files, with columns of clashing names."""
    out = tmp_path_factory.mktemp("odd")
    docs = pa.table({
        "doc_id": pa.array([r[0] for r in ROWS], pa.int64()), "text": pa.array([r[1] for r in ROWS]), "lang": pa.array([r[2] for r in ROWS]), "source": pa.array(["s", None] * 5 + ["s"]), "n_chars": pa.array([None if r[1] is None else len(r[1]) for r in ROWS], pa.int64()),
        "key": pa.array([1] * len(ROWS)), "grp": pa.array(["g"] * len(ROWS)), "word": pa.array(["w"] * len(ROWS)), "n": pa.array([2] * len(ROWS)), "idx": pa.array([0] * len(ROWS)), "stratum": pa.array(["t"] * len(ROWS)), "node": pa.array(["k"] * len(ROWS)),
    })
    (out / "documents.parquet").mkdir()
    pq.write_table(docs.slice(0, 6), out / "documents.parquet" / "a.parquet")
    pq.write_table(docs.slice(6), out / "documents.parquet" / "b.parquet")
    pd.DataFrame({"doc_id": [3, 3, 8, None, 11], "quality": [1, 0, 1, 1, None], "toxic": [0, 0, 0, 0, 0]}).to_parquet(out / "labels.parquet")
    return str(out), docs.to_pylist()


@pytest.fixture(scope="module")
def small():
    path = "/root/testdata/sf0.001"
    if not Path(path).exists():
        pytest.skip("needs the given tables")
    return path, pd.read_parquet(path + "/documents.parquet").to_dict("records")


# ------------------------------------------------------------ 11


def measured(text):
    """The counts of a text, from their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    within = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(within),
        "n_lines": len(lines), "n_capitals": sum("A" <= c <= "Z" for c in text),
    }


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab #\n\t\x0b\x1c\x85é|")), st.integers(0, 3))
def test_measures_of_any_text(text, times):
    text = text * (times + 1)
    assert thresholds.measure(text) == tuple(measured(text)[m] for m in thresholds.MEASURES)


def test_measures_do_not_depend_on_pieces(monkeypatch):
    text = "one two three four\n" * 50 + "tail of it one two three"
    want = thresholds.measure(text)
    monkeypatch.setattr(thresholds, "PIECE", 7)
    assert thresholds.measure(text) == want
    ids = np.array([0, 1, 2, 3, 0, 1, 2, 9, 1, 2, 3])
    assert thresholds.repeated_words(ids, 10) == thresholds.repeated_words(ids, 1 << 21) == 10


@pytest.mark.parametrize("n", [1, 7, 60, 400])
@pytest.mark.parametrize("p", [0.02, 0.3, 0.9])
def test_binomial_tails_and_bounds(n, p):
    for k in {0, 1, n // 3, n // 2, n - 1, n}:
        want = math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert thresholds.binomial_tail(k, n, p) == pytest.approx(min(want, 1), rel=1e-9, abs=1e-12)
        bound = thresholds.upper_bound(k, n, 0.05)
        assert bound == 1 if k == n else thresholds.binomial_tail(k, n, bound) == pytest.approx(0.05, rel=1e-6)


def labelled(rng, n):
    """(doc_id, text, lang, quality): poor documents have symbols or capitals, and a few good ones as well; 'xx' has few labels."""
    rows = []
    for i in range(n):
        lang = "xx" if i % 40 == 0 else (None, "aa", "bb")[i % 3]
        good = rng.random() < 0.8
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(3, 8))) for _ in range(rng.integers(45, 90))]
        if not good or rng.random() < 0.003:
            words = [w + "###" if rng.random() < 0.5 else w for w in words] if rng.random() < 0.7 else [w.upper() for w in words]
        rows.append((i, " ".join(words), lang, int(good)))
    return rows


def verdicts(rows, quality):
    """kept by the method as described, in plain Python: (doc_id -> kept, stratum -> step)."""
    m = {i: measured(t) for i, t, _, _ in rows}
    base = {i: x["n_words"] < 50 or 100 * x["n_repeat_words"] > 50 * x["n_words"] for i, x in m.items()}

    def caught(i, rule, place):
        value = m[i][rule.part] / m[i][rule.whole] if m[i][rule.whole] else None
        c = rule.cutoffs[place] if place >= 0 else None
        return value is not None and c is not None and (value >= c if rule.cutoffs[0] > rule.cutoffs[-1] else value <= c)

    strata = defaultdict(list)
    for i, _, lang, _ in rows:
        if i in quality and not base[i]:
            strata[lang].append(i)
    chosen = {}
    for lang, ids in strata.items():
        tune = [i for i in ids if zlib.crc32(str(i).encode()) % 4 == 0]
        hold = [i for i in ids if i not in set(tune) and quality[i] == 1]
        best, last = None, [-1] * len(thresholds.RULES)
        for step, (back, share) in enumerate(thresholds.LADDER):
            places = []
            for r, rule in enumerate(thresholds.RULES):
                fits = [p for p in range(len(rule.cutoffs)) if sum(caught(i, rule, p) for i in tune if quality[i] == 1) <= share * sum(quality[i] for i in tune)]
                place = max((max(fits) if fits else -1) - back, -1)
                places.append(max(last[r], place if any(caught(i, rule, place) for i in tune if quality[i] == 0) else -1))
            last = places
            out = lambda i: any(caught(i, r, p) for r, p in zip(thresholds.RULES, places, strict=True))  # noqa: E731, B023
            k, n = sum(map(out, hold)), len(hold)
            if not tune or not n or sum(math.comb(n, x) * 0.02**x * 0.98 ** (n - x) for x in range(k + 1)) > 0.05 / len(strata):
                break
            got = sum(out(i) for i in tune if quality[i] == 0)
            if best is None or got > best[0]:
                best = (got, step, places)
        if best:
            chosen[lang] = best[1:]
    kept = {}
    for i, _, lang, _ in rows:
        kept[i] = not base[i] and not (lang in chosen and any(caught(i, r, p) for r, p in zip(thresholds.RULES, chosen[lang][1], strict=True)))
    return kept, {k: v[0] for k, v in chosen.items()}


def test_thresholds_equal_the_method_in_plain_python(spark, tmp_path):
    rows = labelled(np.random.default_rng(5), 4000)
    pd.DataFrame(rows, columns=["doc_id", "text", "lang", "q"]).drop(columns="q").to_parquet(tmp_path / "documents.parquet")
    quality = {r[0]: r[3] for r in rows if r[0] % 7}
    marks = [(i, q) for i, q in quality.items()] + [(0, 1), (0, 0), (14, None), (-1, 1), (8, quality[8])]
    pd.DataFrame(marks, columns=["doc_id", "quality"]).to_parquet(tmp_path / "labels.parquet")
    got = thresholds.op11_risk_thresholds(spark, str(tmp_path)).toPandas().set_index("doc_id")
    kept, steps = verdicts(rows, quality)
    assert got.kept.to_dict() == kept and set(steps) == {None, "aa", "bb"}
    lang = {r[0]: r[2] for r in rows}
    assert all(steps.get(lang[i]) == (None if pd.isna(s) else s) for i, s in got.step.items())
    assert (got.bound.dropna() <= 0.02).all()
    good = [i for i, q in quality.items() if q == 1 and not got.base_failed[i]]
    poor = [i for i, q in quality.items() if q == 0 and not got.base_failed[i] and lang[i] != "xx"]
    assert np.mean([got.kept[i] for i in good]) > 0.97 and np.mean([got.kept[i] for i in poor]) < 0.1


def test_false_rejection_stays_below_alpha(spark):
    """Where a rule cannot be told to be safe, it is not used: rejected shares of 5 % are seldom certified, of 0.2 % nearly always."""
    rng = np.random.default_rng(2)
    certified = lambda p: np.mean([thresholds.binomial_tail(rng.binomial(600, p), 600, thresholds.ALPHA) <= thresholds.DELTA for _ in range(2000)])
    assert certified(0.02) <= 0.06 and certified(0.05) < 0.002 and certified(0.002) > 0.95


def test_op11_takes_odd_rows(spark, odd):
    path, docs = odd
    got = queries.QUERIES["op11_risk_thresholds"](spark, path).toPandas()
    names = thresholds.MEASURES[:5]
    want = sorted((-99 if d["doc_id"] is None else d["doc_id"], *[measured(d["text"])[m] for m in names]) for d in docs)
    assert sorted(zip(got.doc_id.fillna(-99).astype(int), *[got[m] for m in names], strict=True)) == want
    assert (got.kept == ~got.base_failed).all()  # too few labels to certify anything


# ------------------------------------------------------------ 12


def spelled(docs):
    """(word, form, root, n, n_near, form_n) from the definitions."""
    count = Counter()
    for d in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", d["text"] or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if d['doc_id'] is None else d['doc_id']}:{r}".encode())
            count[r[: h % len(r)] + r[h % len(r) + 1 :] if h % 31 == 0 else r] += 1
    return near_words({w: n for w, n in count.items() if n >= 2 and len(w) >= 7})


def near_words(n):
    near = {w: set() for w in n}
    gaps = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
            if (u := w[:i] + w[i + 1 :]) in n:
                near[w].add(u)
                near[u].add(w)
    for g in gaps.values():
        for w in g:
            near[w] |= g - {w}
    best = {w: min(near[w], key=lambda u: (-n[u], u)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w) or "", root(w), n[w], len(near[w]), n[form[w]] if w in form else 0) for w in n)


def found(frame):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in frame.collect())


def test_op12_equals_plain_search(spark, small, odd):
    for path, docs in (small, odd):
        assert found(queries.QUERIES["op12_permuterm_variants"](spark, path)) == spelled(docs)


def test_neighbours_in_runs_ties_chains_and_long_words(spark, monkeypatch):
    long = "ab" * 50 + "c" * 40
    n = {
        "aaaaaaa": 3, "aaaaaaaa": 50, "aaaaaaab": 50, "baaaaaaa": 2, "abababa": 2, "ababababa": 9, "bababab": 3, "ababab": 4, "tionnnn": 2, "tionnn": 30, "tionn": 400, "tion": 5000, "éclairss": 7, "éclairs": 70, "èclairs": 70, "z" * 64: 2, "z" * 65: 20, "z" * 63: 2, "y" + "z" * 63: 200,
        long: 2, long[:70] + long[71:]: 20, long[:70] + "q" + long[71:]: 21, long + "c": 20, long + "cc": 200, "w" * 300: 2, "w" * 299: 2, "w" * 299 + "v": 50,
    }
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = permuterm.roots(permuterm.forms(permuterm.neighbours(words)))
    assert found(got.select("word", "form", "root", "n", "n_near", "form_n")) == near_words(n)
    monkeypatch.setattr(permuterm, "LONG", 5)  # nearly all by digests
    got = permuterm.roots(permuterm.forms(permuterm.neighbours(words)))
    assert found(got.select("word", "form", "root", "n", "n_near", "form_n")) == near_words(n)


def test_random_words(spark):
    rng = np.random.default_rng(0)
    words = {"".join(rng.choice(list("abé"), rng.integers(3, 8))) for _ in range(700)}
    n = {w: int(10 ** rng.uniform(0.4, 4)) for w in sorted(words)}
    near = permuterm.neighbours(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert found(permuterm.roots(permuterm.forms(near)).select("word", "form", "root", "n", "n_near", "form_n")) == near_words(n)


def test_a_long_text_is_counted_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "Some words, SOME words again; été " * 500), (2, None)], "doc_id long, text string")
    want = {"words": 1000, "again": 500, "some": 1000, "été": 500}
    for piece, counted in ((permuterm.PIECE, permuterm.COUNTED), (10, 1)):
        monkeypatch.setattr(permuterm, "PIECE", piece)
        monkeypatch.setattr(permuterm, "COUNTED", counted)
        assert {r.word: r.n for r in permuterm.vocabulary(docs, least=3).collect()} == want


# ------------------------------------------------------------ 13


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i - i % 8
        out.append((nodes[first:i], nodes[i + 1 : first + 8]))
        i //= 8
    return out


def manifested(docs):
    lower = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    groups = defaultdict(list)
    for d in docs:
        fields = [d[c] for c in merkle.FIELDS]
        other = leaf_of(*fields[:4], lower(d["text"])) if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0 else None
        groups[d["lang"]].append((d["doc_id"] is not None, d["doc_id"] or 0, leaf_of(*fields), other))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (known, doc, leaf, other) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = way(trees[g], i) + way(top, k)
            node = other or leaf
            for left, right in path:
                node = H(*left, node, *right)
            out.append((doc if known else -99, leaf, trees[g][-1][0], top[-1][0], H(*[x for left, right in path for x in left + right]), node, node == top[-1][0]))
    return sorted(out)


def proven(frame):
    return sorted((-99 if r.doc_id is None else r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in frame.collect())


def test_op13_equals_plain_trees(spark, small, odd):
    for path, docs in (small, odd):
        assert proven(queries.QUERIES["op13_merkle_veb"](spark, path)) == manifested(docs)


def test_addresses_are_a_layout_in_halves():
    for levels in range(1, 6):
        places = np.concatenate(merkle.addresses(levels))
        assert sorted(places) == list(range(merkle._size(levels))) and places[0] == 0
    four = merkle.addresses(4)  # an upper tree of two levels, then 64 lower trees of two
    assert sorted(np.concatenate(four[:2])) == list(range(9))
    assert [sorted([four[2][s], *four[3][8 * s : 8 * s + 8]]) for s in range(64)] == [list(range(9 + 9 * s, 18 + 9 * s)) for s in range(64)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 511, 512, 513, 4096, 4097, 5000])
def test_trees_of_many_sizes(spark, n):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.col("id").cast("string").alias("text"))
    made = merkle.manifest(docs, {"text": F.col("text")}, "lang", "doc_id")
    levels = tree([leaf_of(i) for i in range(n)])
    assert made.root == levels[-1][0]
    got = {r.key: r for r in merkle.proofs(made).collect()}
    assert len(got) == n and all(r.verified for r in got.values())
    for i in {0, n // 2, n - 1}:
        assert got[i].leaf == leaf_of(i) and got[i].proof_sha256 == H(*[x for left, right in way(levels, i) for x in left + right])


def test_many_groups_and_none(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("g"), F.col("id") % 700).alias("lang"), F.lit("t").alias("text"))
    made = merkle.manifest(docs, {"id": F.col("doc_id")}, "lang", "doc_id")
    assert len(made.upper) == 2 and merkle.proofs(made).filter("verified").count() == 3000
    empty = merkle.manifest(docs.limit(0), {"id": F.col("doc_id")}, "lang", "doc_id")
    assert empty.root is None and merkle.proofs(empty).count() == 0


def test_new_operators_take_empty_tables(spark, tmp_path):
    pd.DataFrame({"doc_id": pd.Series([], dtype="int64"), "text": pd.Series([], dtype=str), "lang": pd.Series([], dtype=str), "source": pd.Series([], dtype=str), "n_chars": pd.Series([], dtype="int64")}).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"doc_id": pd.Series([], dtype="int64"), "quality": pd.Series([], dtype="int64"), "toxic": pd.Series([], dtype="int64")}).to_parquet(tmp_path / "labels.parquet")
    for name in ("op11_risk_thresholds", "op12_permuterm_variants", "op13_merkle_veb"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


# ------------------------------------------------------------ earlier queries, through the registered ones


def test_op2_equals_the_library(spark, odd):
    path, docs = odd
    library = Tokenizer.from_file(TOKENIZERS.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    want = []
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        want.append((d["doc_id"] or -99, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [(r.doc_id or -99, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op2_bpe_lexicon"](spark, path).collect()]
    assert sorted(got) == sorted(want)


def test_op3_reads_the_payload_back(spark, odd):
    path, docs = odd
    want = []
    for d in docs:
        raw = (d["text"] or "").encode()
        payload = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        want.append((d["doc_id"] or -99, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])))
    frame = queries.QUERIES["op3_media_columns"](spark, path)
    got = [(r.doc_id or -99, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in frame.collect()]
    assert sorted(got) == sorted(want)


def test_op7_pieces_hold_the_librarys_ids(spark, small):
    path, docs = small
    library = Tokenizer.from_file(TOKENIZERS.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    got = queries.QUERIES["op7_best_fit_packing"](spark, path).toPandas()
    want = {}
    for d in docs:
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[d["doc_id"], k] = (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum()[:-1]] and s.length.sum() <= 4096
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) + 2


def test_op9_equals_plain_products(spark, small):
    path, _ = small
    rows = pd.read_parquet(path + "/embeddings.parquet")
    v = np.floor(64 * np.stack(rows.embedding.to_numpy()).astype(float)).astype(np.int64)
    ids = rows.vec_id.to_numpy()
    want = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = v @ v[q]
        order = sorted((-int(s), int(i)) for s, i in zip(score, ids, strict=True) if i != ids[q])[:20]
        want += [(int(ids[q]), k, i, -s) for k, (s, i) in enumerate(order, 1)]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in queries.QUERIES["op9_topk_threshold"](spark, path).collect()]
    assert sorted(got) == sorted(want)


def test_only_results_are_left_of_settled_queries(spark, odd):
    path, docs = odd
    at = Path(shared_dir(spark).removeprefix("file:"))
    for name in ("op3_media_columns", "op11_risk_thresholds", "op12_permuterm_variants", "op13_merkle_veb"):
        before = set(at.iterdir())
        rows = queries.QUERIES[name](spark, path)
        left = set(at.iterdir()) - before
        assert len(left) == 1 and left.pop().name.startswith(name) and rows.count() == (len(docs) if "op12" not in name else rows.count())


def test_op4_sizes_and_choice_equal_plain_compression(spark, small, odd):
    """Each text compressed anew with each dictionary, piece by piece as described."""
    for path, docs in (small, odd):
        frame = spark.read.parquet(path + "/documents.parquet")
        learned = langid.fit(frame.filter(F.expr("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2")))
        compressors = {}
        for name, d in learned.items():
            held = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=6)
            compressors[name] = zstandard.ZstdCompressor(level=6, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)
        want = []
        for d in docs:
            text = d["text"] or ""
            held_out = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2
            if not any(c.isalpha() for c in text) or not learned:
                want.append((d["doc_id"] or -99, held_out, "und", 0.0, True))
                continue
            raw = re.sub(r"[\W\d_]+", " ", text).lower().encode()
            words = raw.split(b" ")
            pieces = [b" ".join(words[len(words) * k // 8 :]) for k in range(min(8, len(words)))] if len(raw) < 1024 else [raw[i : i + 8192] for i in range(0, len(raw), 8192)]
            size = {name: sum(len(c.compress(p)) for p in pieces) for name, c in compressors.items()}
            best, *others = sorted(size, key=lambda x: (size[x], x))
            margin = 1 - size[best] / size[others[0]] if others else 1.0
            want.append((d["doc_id"] or -99, held_out, best, round(margin, 9), margin < 0.002))
        got = [(r.doc_id or -99, bool(r.held_out), r.lang_pred, round(r.margin, 9), r.rejected) for r in queries.QUERIES["op4_language_id"](spark, path).collect()]
        assert sorted(got) == sorted(want)


def test_pipeline_equals_plain_stages(spark, small):
    """Every stage on what the one before it kept, against a plain version of its decision."""
    path, _ = small
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(path + "/documents.parquet")
    model = langid.Classifier(langid.fit(docs.filter(F.expr("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2"))))
    marks, at = toxicity._marks(spark.read.parquet(path + "/labels.parquet")), shared_dir(spark).removeprefix("file:")

    def identified(rows):
        return [r for r in rows if (p := model.predict(r["text"]))[0] != "und" and p[2] >= langid.MIN_MARGIN]

    def apart(rows):
        words = [simhash.words_of(r["text"] or "") for r in rows]
        sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {()} for w in words]
        parent = list(range(len(rows)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(rows)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    a, b = sorted((find(i), find(j)), key=lambda k: rows[k]["doc_id"])
                    parent[b] = a
        return [r for i, r in enumerate(rows) if find(i) == i]

    for name, plain in (("language ID", identified), ("toxicity", None), ("SimHash near-dedup", apart)):
        before = docs.collect()
        kept = stages[name](spark, docs, path).toPandas()
        kept.to_parquet(f"{at}/{name.replace(' ', '-')}.parquet")
        if plain:
            want = plain([r.asDict() for r in before])
        else:
            scores = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, marks)).collect()}
            want = [r.asDict() for r in before if not scores[r.doc_id].predicted]
        assert sorted(kept.doc_id) == sorted(r["doc_id"] for r in want) and len(kept) < len(before), name
        docs = spark.read.parquet(f"{at}/{name.replace(' ', '-')}.parquet").select(*docs.columns)
    library = Tokenizer.from_file(TOKENIZERS.path("word_bpe_49k.json"))
    cut = stages["substring dedup"](spark, docs, path)
    texts = {r.doc_id: r.text or "" for r in cut.collect()}
    whole = {r.doc_id: r.text or "" for r in docs.collect()}
    assert texts.keys() == whole.keys() and all(len(texts[i]) <= len(whole[i]) for i in texts)
    packed = packing.packed_sequences(cut).toPandas()
    for i, g in packed.groupby("doc_id"):
        assert g.length.sum() == len(library.encode(texts[i], add_special_tokens=False).ids) + 1
    assert (packed.groupby("sequence_id").length.sum() <= 4096).all() and set(packed.doc_id) == set(texts)
