"""Operator 7: best-fit packing of token pieces by best-two-fit.

Documents are tokenised, cut only where they exceed a sequence, and spread by a hash over shards of
bounded size that are packed on their own; only lengths are shuffled. Within a shard a bin is filled
greedily with the largest pieces that still fit; then its smallest piece is replaced by the two
unpacked pieces that fill the widened gap best, if they fill it better.

Null and empty texts hold the end id alone. Rows that share a key are packed as separate documents
(their pieces repeat). Pieces of one length are interchangeable; they go by key and piece. Texts are
read whole, whatever their length; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.bpe import Encoder, LowerWordSplitter, Merger
from helixframe.llm.common import keep, table, text_chunks

CAPACITY, END_ID = 4096, 1
#: Pieces in a shard, about: more waste less at shard ends, fewer bound a task's memory and time.
SHARD_PIECES = 20_000
#: Of words and their ids that one worker remembers, about.
CACHE_BYTES = 40 << 20


class Tokens:
    """Token ids of texts as little-endian bytes; one per worker."""

    def __init__(self, path: str):
        merger = Merger(path)
        self.encoder = Encoder(merger, LowerWordSplitter(), merger.merge, CACHE_BYTES)

    def encode(self, texts: list[str], end_id: int = END_ID) -> list[bytes]:
        end = np.array([end_id], "<u4").tobytes()
        return [ids + end for ids in self.encoder.encode(texts)]


@lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32): each document's tokens, cut where it exceeds capacity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                ids = batch.column(batch.schema.get_field_index(key)).slice(begin, len(texts)).to_pylist()
                rows = []
                for k, raw in zip(ids, tokens.encode(texts), strict=True):
                    for i, at in enumerate(range(0, len(raw), capacity * 4)):
                        part = raw[at : at + capacity * 4]
                        rows.append((k, i, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[key, "piece", "start", "length", "ids_crc32"])

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return docs.select(key, text).mapInArrow(run, f"{key} long, piece int, start long, length long, ids_crc32 long")


class _Lengths:
    """The unpacked lengths of a shard, with how many there are of each."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.count = np.bincount(lengths, minlength=capacity + 1).tolist()
        self.present = [n for n in range(1, capacity + 1) if self.count[n]]

    def largest(self, limit: int) -> int:
        """The largest unpacked length up to limit, or 0."""
        at = bisect_right(self.present, limit)
        return self.present[at - 1] if at else 0

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            del self.present[bisect_right(self.present, n) - 1]

    def put_back(self, n: int) -> None:
        if not self.count[n]:
            self.present.insert(bisect_right(self.present, n), n)
        self.count[n] += 1

    def best_two(self, gap: int) -> tuple[int, int]:
        """The two unpacked lengths with the largest sum up to gap (two pointers), or zeros."""
        have, best = self.present, (0, 0)
        low, high = 0, bisect_right(have, gap) - 1
        while low <= high:
            total = have[low] + have[high]
            if total > gap or (low == high and self.count[have[low]] < 2):
                high -= 1
                continue
            if total > sum(best):
                best = (have[low], have[high])
                if total == gap:
                    break
            low += 1
        return best


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of lengths, none over capacity."""
    left, bins = _Lengths(np.asarray(lengths), capacity), []
    while left.present:
        room, contents = capacity, []
        while room and (n := left.largest(room)):
            left.take(n)
            contents.append(n)
            room -= n
        if room and len(contents) > 1 and left.present:
            smallest = contents[-1]
            pair = left.best_two(room + smallest)
            if sum(pair) > smallest:
                contents.pop()
                left.put_back(smallest)
                for n in pair:
                    left.take(n)
                contents += pair
        bins.append(contents)
    return bins


def pack(found: DataFrame, n_pieces: int, capacity: int = CAPACITY, key: str = "doc_id", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """found with sequence_id and offset."""
    shards = max(1, -(-n_pieces // shard_pieces))
    columns = [key, "piece", "start", "length", "ids_crc32"]

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", key, "piece"], kind="stable", ignore_index=True)
        lengths = frame["length"].to_numpy()
        after = np.searchsorted(lengths, np.arange(capacity + 2)).tolist()  # length -> the next unplaced row of it
        row_of, sequence, offset = [], [], []
        for b, contents in enumerate(best_two_fit(lengths, capacity)):
            at = 0
            for n in contents:
                row_of.append(after[n])
                after[n] += 1
                sequence.append(b)
                offset.append(at)
                at += n
        order = np.array(row_of)
        out = frame.iloc[order].reset_index(drop=True)
        out["sequence_id"] = np.array(sequence, np.int64) * shards + int(frame["shard"].iloc[0])
        out["offset"] = np.array(offset, np.int64)
        return out[[*columns, "sequence_id", "offset"]]

    # found is a stored table, so row numbers repeat on a retry; with them, rows that share a key spread too
    spread = found.select(*columns, F.pmod(F.xxhash64(key, "piece", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"))
    return spread.groupBy("shard").applyInPandas(place, f"{key} long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = keep(pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")), "pieces")
    return pack(found, found.count())


def packed_sequences(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the packing of all documents that are left.

    Null and empty texts are a sequence's single token; rows that share a key, or have none, are each
    packed; an empty table gives an empty result. Other columns are not returned.
    """
    import public_tokenizers

    found = keep(pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces")
    return pack(found, found.count())
