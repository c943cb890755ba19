"""Operator 2: byte-pair encoding and decoding with a minimal acyclic transducer of frequent words.

The corpus' most frequent words (counted over all documents) and their token ids are compiled into
a minimal acyclic automaton whose transitions carry additive outputs; the outputs on a word's path
sum to its row in a table of ids. The automaton is one flat file that each worker maps into memory.
Words outside it are merged exactly (helixframe.llm.bpe), so results never depend on its contents.

Null texts count as empty: no ids, and an empty decoded text. Repeated rows are encoded alike; equally
frequent words are all in the lexicon or all out of it. Texts are read whole, whatever their length;
an empty table gives an empty lexicon and an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.bpe import ByteLevelSplitter, Encoder, Merger
from helixframe.llm.common import keep, table, text_chunks

#: Words in the lexicon: bounds the driver's share and the broadcast (about 40 bytes a word).
LEXICON_WORDS = 32_768
#: Of words and their ids that one worker remembers, about, and different words it counts at a time.
CACHE_BYTES, COUNT_WORDS = 40 << 20, 200_000


def compile_transducer(entries: dict[bytes, bytes]) -> bytes:
    """A minimal acyclic transducer of word -> ids (32-bit) as one block of little-endian integers."""
    words = sorted(w for w in entries if w)
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []  # state -> (final, ((byte, target), ...))

    def freeze(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(frozen)
            frozen.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # open states of the last word: [final, arcs]; arcs of a closed suffix are final
    labels: list[int] = []

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            path[-1][1].append((labels.pop(), freeze(final, arcs)))

    for w in words:
        same = 0
        while same < min(len(labels), len(w)) and labels[same] == w[same]:
            same += 1
        close(same)
        for b in w[same:]:
            labels.append(b)
            path.append([False, []])
        path[-1][0] = True
    close(0)
    root = freeze(*path[0])
    below = np.zeros(len(frozen), np.int64)  # words accepted from a state; targets are frozen before their sources
    keys, targets, outputs = [], [], []
    for s, (final, arcs) in enumerate(frozen):
        count = int(final)
        for b, to in arcs:
            keys.append(s * 256 + b)
            targets.append(to)
            outputs.append(count)
            count += below[to]
        below[s] = count
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    ids = [np.frombuffer(entries[w], "<u4") for w in words]
    parts = [
        np.array(keys, np.int64)[order], np.array(targets, np.int64)[order], np.array(outputs, np.int64)[order],
        np.array([f for f, _ in frozen], np.int64), np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int64),
        np.concatenate([np.asarray(x, np.int64) for x in ids] or [np.zeros(0, np.int64)]),
    ]
    head = np.array([root, *map(len, parts)], np.int64)
    return b"".join(x.astype("<i8").tobytes() for x in (head, *parts))


class Transducer:
    """Looks up many words at once in a mapped automaton."""

    def __init__(self, block: bytes):
        with tempfile.NamedTemporaryFile(delete=False) as f:
            f.write(block)
        with open(f.name, "rb") as g:
            data = np.frombuffer(mmap.mmap(g.fileno(), 0, access=mmap.ACCESS_READ), "<i8")
        os.unlink(f.name)  # the mapping keeps it until the worker ends
        self.root, at = int(data[0]), 7
        parts = []
        for n in data[1:7]:
            parts.append(data[at : at + int(n)])
            at += int(n)
        self.keys, self.targets, self.outputs, self.final, self.starts, self.ids = parts

    def rows(self, words: list[bytes]) -> np.ndarray:
        """The row of each word's ids, -1 where the lexicon lacks it."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        begin = np.r_[0, np.cumsum(lengths)[:-1]] if n else lengths
        raw = np.frombuffer(b"".join(words), np.uint8)
        state, out, live = np.full(n, self.root), np.zeros(n, np.int64), np.flatnonzero(lengths > 0)
        found = np.full(n, -1, np.int64)
        depth = 0
        while len(live) and len(self.keys):
            key = state[live] * 256 + raw[begin[live] + depth]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            out[live] += self.outputs[at]
            depth += 1
            over = lengths[live] == depth
            ended = live[over]
            ended = ended[self.final[state[ended]] == 1]
            found[ended] = out[ended]
            live = live[~over]
        return found

    def ids_of(self, row: int) -> bytes:
        return self.ids[self.starts[row] : self.starts[row + 1]].astype("<u4").tobytes()


class Codec:
    """Encodes and decodes texts; one per worker."""

    def __init__(self, path: str, block: bytes | None):
        self.merger = Merger(path)
        self.lexicon = Transducer(block) if block else None
        self.encoder = Encoder(self.merger, ByteLevelSplitter(), self._ids, CACHE_BYTES)

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """From the lexicon, and by merging where it lacks a word."""
        rows = self.lexicon.rows(words) if self.lexicon else np.full(len(words), -1)
        rest = np.flatnonzero(rows < 0)
        merged = dict(zip(rest.tolist(), self.merger.merge([words[i] for i in rest]), strict=True))
        return [merged[i] if row < 0 else self.lexicon.ids_of(row) for i, row in enumerate(rows.tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<u4") for ids in self.encoder.encode(texts)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.merger.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the pre-tokens of all texts; counted in each batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, c = ByteLevelSplitter(), Counter()
        for batch in batches:
            for _, texts in text_chunks(batch, text):
                for t in texts:
                    c.update(splitter.words(t))
                if len(c) > COUNT_WORDS:
                    yield rows(c)
                    c.clear()
        yield rows(c)

    def rows(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(c.keys(), pa.string()), "n": pa.array(c.values(), pa.int64())})

    return docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS, text: str = "text") -> bytes:
    """The mapped block of the corpus' most frequent words, at most so many; equally frequent words are in or out together."""
    # a cut of the counts leaves at most so many words, so no task or driver sorts more than it needs
    counts = keep(word_counts(docs, text).filter("n > 1").withColumn("step", F.floor(F.log2("n") * 64).cast("int")), "counts")
    steps, held, least = sorted(map(tuple, counts.groupBy("step").count().collect()), reverse=True), 0, 1 << 30
    for step, n in steps:
        if (held := held + n) > words:
            break
        least = step
    top = [r.word for r in counts.filter(F.col("step") >= least).select("word").collect()]
    raw = [w.encode() for w in top if w]
    return compile_transducer(dict(zip(raw, Merger(path).merge(raw), strict=True)))


@lru_cache(maxsize=2)
def _codec(path: str, key: str, blocks) -> Codec:
    return Codec(path, blocks.value)


class _Block:
    """A broadcast block, hashed by its content so that a worker keeps one codec for it."""

    def __init__(self, spark, block: bytes):
        self.shared, self.key = spark.sparkContext.broadcast(block), hashlib.sha256(block).hexdigest()

    @property
    def value(self) -> bytes:
        return self.shared.value

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other) -> bool:
        return self.key == other.key


def _map(docs: DataFrame, path: str, block: bytes, key: str, text: str, row, schema: str) -> DataFrame:
    shared = _Block(docs.sparkSession, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, shared.key, shared)
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                rows = [row(codec, ids) for ids in codec.encode(texts)]
                ids = batch.column(batch.schema.get_field_index(key)).slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in zip(*rows, strict=True))], names=names)

    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(key, text).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, block: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of each text."""
    return _map(docs, path, block, key, text, lambda c, ids: (ids.astype(np.int32),), f"{key} long, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of token ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, None)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            texts = [codec.decode(x.as_py() or []) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"{key} long, text string")


def round_trip(docs: DataFrame, path: str, block: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes, then decodes each text in one pass and returns digests of both."""

    def row(codec: Codec, ids: np.ndarray) -> tuple:
        plain = ids.tolist()
        csv = str(plain)[1:-1].replace(" ", "")
        return len(plain), hashlib.sha256(csv.encode()).hexdigest(), hashlib.sha256(codec.decode(plain).encode()).hexdigest()

    return _map(docs, path, block, key, text, row, f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe_lexicon(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, docs = public_tokenizers.path("byte_bpe_50k.json"), table(spark, sf_dir, "documents")
    return round_trip(docs, path, build_lexicon(docs, path))
