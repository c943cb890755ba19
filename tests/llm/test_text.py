"""Tokenisers, media, licences, passages and packing against libraries and brute force."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helixframe.llm import lexicon, licenses, media, packing, passages
from helixframe.llm.bpe import Merger

ODD = ["", None, "  a  b \n\n c", "a\n  b", "trail ", "ÀÉ²³½ x", "ΑΣ Σ Ωσ", "éa", "日本語 と 漢字", "<|endoftext|>x <|endoftext|>", "it's we'LL 'sfoo", "\x1c\x1d a\x85b\xa0c", "aaaaaaaa" * 300, "a" * 1000 + "b" * 900, "İstanbul ẞ", "1234567 ٣٤"]
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_round_trip_equals_the_library(spark):
    d, tok = docs(spark, ODD * 2), Tokenizer.from_file(BYTES)
    block = lexicon.build_lexicon(d, BYTES, words=8)
    got = {r.doc_id: r for r in lexicon.round_trip(d, BYTES, block).collect()}
    assert len(got) == 2 * len(ODD)
    for i, t in enumerate(ODD * 2):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    back = {r.doc_id: r.text for r in lexicon.decode(lexicon.encode(d, BYTES, block), BYTES).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(ODD))
    assert lexicon.round_trip(d.limit(0), BYTES, block).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 50_000), min_size=1, max_size=4), max_size=30), st.lists(st.binary(max_size=6), max_size=20))
def test_transducer_holds_its_words_and_no_others(entries, others):
    block = lexicon.compile_transducer({w: np.array(ids, "<u4").tobytes() for w, ids in entries.items()})
    t = lexicon.Transducer(block)
    asked = [*entries, *others]
    for w, row in zip(asked, t.rows(asked).tolist(), strict=True):
        assert (row >= 0) == (w in entries)
        if row >= 0:
            assert np.frombuffer(t.ids_of(row), "<u4").tolist() == entries[w]


@settings(max_examples=100, deadline=None)
@example(":\U000323b0 a\U000323b0")  # letters and capitals newer than one library's Unicode tables
@example("x\u1c89\ua7cb \U00010d50")
@given(st.text(max_size=40))
def test_any_text_equals_the_libraries(text):
    codec, tokens = _cached()
    a, b = _libraries()
    assert codec.encode([text])[0].tolist() == a.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.encode([text])[0], "<u4").tolist() == [*b.encode(text, add_special_tokens=False).ids, 1]


_held: list = []


def _cached():
    if not _held:
        _held.append((lexicon.Codec(BYTES, None), packing.Tokens(WORDS)))
        _held.append((Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)))
    return _held[0]


def _libraries():
    _cached()
    return _held[1]


def test_heap_and_side_by_side_merges_agree():
    m = Merger(BYTES)
    for w in (b"aaaaaaa", b" thethe", bytes(range(60, 120))):
        assert m.merge([w])[0] == m._merge_long(w)


def test_payload_round_trip(spark):
    d = docs(spark, [None, "", "x" * 192, "y" * 193, "é" * 5000, "x" * 192])
    got = {r.doc_id: r for r in media.payload_features(media.store_texts(d)).collect()}
    for i, t in enumerate(["", "", "x" * 192, "y" * 193, "é" * 5000, "x" * 192]):
        raw = t.encode()
        p = raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" ")
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256, got[i].tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
    assert got[2][1:] == got[5][1:]


def test_decoders_and_bad_images(spark):
    rng = np.random.default_rng(1)
    rgb = rng.integers(0, 256, (5, 7, 3), dtype=np.uint8)
    assert (media.decode_image(media.ppm(rgb)) == rgb).all() and (media.decode_image(media.bmp(rgb)) == rgb).all()
    assert media.decode_image(b"P2 # grey\n2 1\n15\n0 15")[:, :, 0].tolist() == [[0, 255]]
    assert media.decode_image(b"P1\n3 1\n1 0 1")[:, :, 0].tolist() == [[0, 255, 0]]
    assert media.decode_image(b"P4\n3 1\n\xa0")[:, :, 0].tolist() == [[0, 255, 0]]
    rows = [(1, media.ppm(rgb)), (2, b"P6\n9 9\n255\nshort"), (3, None), (4, b"GIF")]
    got = {r.doc_id: r for r in media.tiles(spark.createDataFrame(rows, "doc_id long, media binary")).collect()}
    assert [got[i].status for i in (1, 2, 3, 4)] == ["ok", "bad", "bad", "bad"]
    assert np.load(__import__("io").BytesIO(got[1].tile)).shape == (16, 16, 3)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.integers(1, 9), st.integers(1, 9))
def test_area_resize_against_sums_of_overlaps(h, w, height, width):
    image = np.random.default_rng(h * 100 + w).integers(0, 256, (h, w, 1), dtype=np.uint8)

    def overlaps(n, m):
        return np.array([[max(0.0, min((i + 1) * n / m, j + 1) - max(i * n / m, j)) for j in range(n)] for i in range(m)])

    want = overlaps(h, height) @ image[:, :, 0] @ overlaps(w, width).T * (height * width / (h * w))
    assert np.abs(media.area_resize(image, height, width)[:, :, 0] - want).max() <= 0.5 + 1e-6


def test_licences(spark):
    header = "\n".join(["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file", "except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,", "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."])
    d = docs(spark, [None, "", "no mark before\nReleased under the MIT License.\nx", header, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", "the license of nothing"])
    got = {r.doc_id: (r.licenses, r.n_known) for r in licenses.scan(d.selectExpr("*", "1 as licenses_", "'x' as found")).collect()}
    assert got == {0: ([], 0), 1: ([], 0), 2: (["MIT"], 1), 3: (["Apache-2.0-header"], 4), 4: (["CC-BY-NC-4.0"], 2), 5: ([], 0)}


MIT = """MIT License

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
"""
APACHE = """# Copyright 2024 Some One
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
BSD = """Copyright (c) 2024, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE.
"""
BSD3 = BSD.replace("THIS SOFTWARE", """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE""")
GPL = """    Copyright (C) 2024  Some One

    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""


def test_every_known_sentence_is_found_alone(spark):
    from helixframe.llm.licenses import SENTENCES, hints

    lines = [(i, s, name) for i, (name, s) in enumerate(SENTENCES)]
    docs = spark.createDataFrame([(i, s.upper() if i % 2 else s + ".") for i, s, _ in lines] + [(100 + i, f"before\n{s.replace(' ', chr(10), 1)}\nafter") for i, s, _ in lines], "doc_id long, text string")
    got = {r.doc_id: r.sentence_ids for r in licenses.scan(docs).collect()}
    assert got == {k + i: [name] for i, _, name in lines for k in (0, 100)}
    assert all(any(w in s.split() for w in hints([x for _, x in SENTENCES])) for _, s in SENTENCES)


def test_unaltered_licence_texts(spark):
    texts = [MIT, APACHE, BSD, BSD3, GPL, GPL.replace("version 3", "version 2").replace("\n", "\r\n"), BSD.replace("1. ", "(a) ").replace("2. ", "* ")]
    got = {r.doc_id: r.licenses for r in licenses.scan(docs(spark, texts)).collect()}
    want = ["MIT-text", "Apache-2.0-header", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0-or-later", "GPL-2.0-or-later", "BSD-2-Clause"]
    assert got == {i: [x] for i, x in enumerate(want)}


def brute_repeats(texts, min_words=passages.MIN_WORDS):
    seen, out = set(), []
    for t in texts:
        flags, us = [], passages.units(t or "")
        for u in us:
            flags.append(u[3:] in seen)
            seen.add(u[3:])
        cut, i = [], 0
        while i < len(us):
            j = i
            while j < len(us) and flags[j]:
                j += 1
            if j > i and sum(u[2] for u in us[i:j]) >= min_words:
                cut.append((us[i][0], us[j - 1][1]))
            i = max(j, i + 1)
        if t is not None:
            for a, b in reversed(cut):
                t = t[:a] + t[b:]
        out.append((t, cut))
    return out


def test_passages_against_brute_force(spark):
    rng = np.random.default_rng(5)
    shared = [" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij", "kl"], 9)) + "." for _ in range(6)]
    texts = [None, "", "word", *[" ".join(rng.choice([*shared, "Own one.", f"Only here {i}.", "x\ny"], 8)) for i in range(60)], "\n".join(shared), "\n".join(shared)]
    d = docs(spark, texts).selectExpr("*", "cast(null as string) as removed_", "doc_id as rank")
    got = {r.doc_id: (r.text, [tuple(s) for s in r.removed]) for r in passages.remove_repeats(d).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)
    assert passages.remove_repeats(d.limit(0)).count() == 0


def test_passages_within_long_sentences(spark):
    rng = np.random.default_rng(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ra") for b in ("ban", "der", "fil", "gor", "hut", "jem", "kas")]
    passage = " ".join(rng.choice(words, 60))
    texts = [f"{' '.join(f'o{i}x{j}' for j in range(9 + i))} {passage} {' '.join(f'e{i}x{j}' for j in range(7))}." for i in range(20)]
    got = {r.doc_id: r.text for r in passages.remove_repeats(docs(spark, texts)).collect()}
    assert got[0] == texts[0]
    for i in range(1, 20):
        assert set(texts[i].split()) - set(passage.split()) <= set(got[i].split())
        assert sum(w in words for w in got[i].split()) < 30
    assert [passages.units(t)[-1][1] for t in texts] == [len(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_two_fit_packs_everything(lengths):
    bins = packing.best_two_fit(np.array(lengths, int), 50)
    assert sorted(n for b in bins for n in b) == sorted(lengths) and all(sum(b) <= 50 for b in bins)


def test_best_two_fit_replaces_the_smallest():
    assert [6, 2, 2] in packing.best_two_fit(np.array([6, 3, 2, 2]), 10)


def test_packing_of_documents(spark):
    texts = [None, "", "word " * 5000, *[f"some text {i}" for i in range(300)]]
    found = packing.pieces(docs(spark, texts), WORDS, capacity=64)
    rows = packing.pack(found, found.count(), 64, shard_pieces=100).collect()
    assert {r.doc_id for r in rows} == set(range(len(texts)))
    at: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 64
    assert sum(r.length for r in rows if r.doc_id == 2) == 5001
    assert packing.pack(found.limit(0), 0).count() == 0
