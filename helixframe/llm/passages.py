"""Operator 6: removal of repeated passages by hashing lines, cut further at sentence ends and, in long
sentences, behind words that their own hash chooses, so that passages that begin or end within a sentence
meet by its parts.

Units are normalised (lower case, words joined by one space) and hashed with 128 bits. The earliest
occurrence in (rank, row, position) order of each digest stays; other occurrences go when they stand in a
run of consecutive repeated units of at least min_words words, so that common short sentences by
themselves stay (min_words 0 removes every repeat). Offsets of what was removed refer to the original
text, in characters.

Null texts stay null; a text may become empty. Every row is a document of its own, whatever key it
shares: of equal rows the later ones lose their text. Rows without a key rank last; ties go by place in
the stored table. Texts are read whole, whatever their length; an empty table stays empty. Columns
besides text are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm.common import identified, keep, table, text_chunks

MIN_WORDS = 10
#: A unit ends at a line end, or at a sentence mark that white space follows.
_END = re.compile(r"\n|[.!?]+[ \t]+")


#: Units of more words are cut behind about one word in CUT_SHARE.
LONG_WORDS, CUT_SHARE = 15, 8
_WORD = re.compile(r"\S+\s*")


@lru_cache(maxsize=1 << 16)
def _cuts(word: str) -> bool:
    return xxhash.xxh64_intdigest(word) % CUT_SHARE == 0


def units(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, end, words, digest high, digest low) of the units that hold a word."""
    out, at = [], 0

    def add(start: int, end: int, words: list[str]) -> None:
        h = xxhash.xxh3_128_intdigest(" ".join(words))
        out.append((start, end, len(words), _signed(h >> 64), _signed(h & (1 << 64) - 1)))

    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        words = text[at:end].lower().split()
        if len(words) > LONG_WORDS:
            ends = [m.end() for m in _WORD.finditer(text, at, end)]
            begin = 0
            for i, word in enumerate(words, 1):
                if i == len(words) or _cuts(word):
                    add(at, ends[i - 1], words[begin:i])
                    at, begin = ends[i - 1], i
        elif words:
            add(at, end, words)
        at = end
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


LAST_RANK = (1 << 63) - 1


def unit_table(rows: DataFrame) -> DataFrame:
    """(rank, file, at, place, h, l): every unit of every text of (rank, file, at, text); offsets are found again where they are needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch):
                part = batch.slice(begin, len(texts))
                found = [units(t) for t in texts]
                counts = np.array([len(u) for u in found])
                where = np.repeat(np.arange(len(texts)), counts)
                place = np.arange(len(where)) - np.repeat(np.cumsum(counts) - counts, counts)
                digests = np.array([u[3:] for us in found for u in us], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(where)) for c in part.columns[:3]), pa.array(place.astype(np.int32)), pa.array(digests[:, 0]), pa.array(digests[:, 1])], names=["rank", "file", "at", "place", "h", "l"])

    return rows.select(F.coalesce("rank", F.lit(LAST_RANK)).alias("rank"), "file", "at", "text").mapInArrow(run, "rank long, file long, at long, place int, h long, l long")


#: A digest with more than one in so many of all repeated occurrences is hot: there are at most so many hot digests.
HOT_SHARE = 1000


def repeated(found: DataFrame) -> DataFrame:
    """(file, at, place) of the occurrences that aren't their digest's earliest; found is a stored table.

    The few hot digests (at most HOT_SHARE, whatever the input) are broadcast, so that no task gets
    all occurrences of one; the others meet by a shuffle.
    """
    at = F.struct("rank", "file", "at", "place")
    first = found.groupBy("h", "l").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = keep(first, "first")
    limit = (first.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE
    hot, cool = first.filter(F.col("n") > limit).select("h", "l", "first"), first.filter(F.col("n") <= limit).select("h", "l", "first")
    common = found.join(F.broadcast(hot), ["h", "l"])
    others = found.join(F.broadcast(hot.select("h", "l")), ["h", "l"], "left_anti").join(cool, ["h", "l"])
    return common.unionByName(others).filter(at != F.col("first")).select("file", "at", "place")


def spans(text: str, places: list[int], min_words: int) -> list[dict[str, int]]:
    """What to remove of a text: its units at places, in runs of at least min_words words, joined where they touch."""
    every, gone = units(text), []
    run: list[int] = []
    for place in [*sorted(places), -1]:
        if run and place != run[-1] + 1:
            if sum(every[p][2] for p in run) >= min_words:
                start, end = every[run[0]][0], every[run[-1]][1]
                if gone and gone[-1]["end"] == start:
                    gone[-1]["end"] = end
                else:
                    gone.append({"start": start, "end": end})
            run = []
        run.append(place)
    return gone


def _cut(docs: DataFrame, rank: str, text: str, min_words: int, stored: bool) -> DataFrame:
    """(docs, text, removed): all columns of docs as they were, the text without its repeats, and their (start, end)."""
    rows = identified(docs, stored)
    found = unit_table(rows.select(F.col(f"docs.`{rank}`").cast("long").alias("rank"), "file", "at", F.col(f"docs.`{text}`").alias("text")))
    # a document's list of places is bounded by its own length, like its text
    places = repeated(keep(found, "units")).groupBy("file", "at").agg(F.collect_list("place").alias("places"))
    joined = rows.join(places, ["file", "at"], "left").select("docs", F.col(f"docs.`{text}`").alias("text"), "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch):
                part = batch.slice(begin, len(texts))
                kept, removed = [], []
                for value, at in zip(texts, part.column(2), strict=True):
                    gone = spans(value, at.as_py(), min_words) if at.is_valid else []
                    ends = [0, *(x["end"] for x in gone)]
                    kept.append("".join([value[a:b] for a, b in zip(ends, [*(x["start"] for x in gone), len(value)], strict=True)]))
                    removed.append(gone)
                cut_text = pc.if_else(part.column(1).is_valid(), pa.array(kept, pa.string()), pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), cut_text, pa.array(removed, span_type)], names=["docs", "text", "removed"])

    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    return joined.mapInArrow(cut, T.StructType([joined.schema["docs"], T.StructField("text", T.StringType()), T.StructField("removed", span)]))


def remove_repeats(docs: DataFrame, rank: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, stored: bool = False) -> DataFrame:
    """docs with repeated passages cut out of text, and removed: array of (start, end) in the original text.

    A column of docs that is itself named removed is replaced. stored: docs is a plain scan of files.
    """
    out = _cut(docs, rank, text, min_words, stored)
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"docs.`{c}`") for c in docs.columns if c != "removed"], "removed")


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), stored=True)
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.expr("cast(aggregate(removed, 0, (a, x) -> a + x.end - x.start) as long)").alias("removed_chars"), F.to_json("removed").alias("removed_spans"))


def cut_repeats(docs: DataFrame, stored: bool = False) -> DataFrame:
    """Pipeline stage: the columns of docs, without repeated passages; documents left without a word go."""
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    out = _cut(docs, "doc_id", "text", MIN_WORDS, stored).filter(F.col("text").rlike(r"\S"))
    return out.select(*[new.get(c, F.col(f"docs.`{c}`")).alias(c) for c in docs.columns])
