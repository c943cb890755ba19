"""File inventories and fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.plans.stored import written


def content_fingerprint(inventory: DataFrame, *by: str) -> DataFrame:
    """(by..., fingerprint): SHA-256 of the path, hash and size lines, sorted by path, each ended by a newline; one for each run, or for all.

    Runs are gathered, as their lists are small. A fingerprint of all, null without lines, is of any length:
    lines are sorted over all tasks, and one task hashes them as a stream.
    """
    line = F.concat_ws("\t", "path", "sha256", F.col("size_bytes").cast("string"))
    if not by:
        return _streamed(inventory.select("path", line.alias("line")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("path", line.alias("line")))), lambda x: x["line"])
    return inventory.groupBy(*by).agg(F.sha2(F.concat(F.array_join(lines, "\n"), F.lit("\n")).cast("binary"), 256).alias("fingerprint"))


def _streamed(lines: DataFrame) -> DataFrame:
    """(fingerprint) of lines (path, line): ranges of paths are sorted and joined to pieces of text, hashed in their order."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = "".join(f"{x}\n" for x in batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(0, 1), pa.array([text])], names=["at", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = sha256(), False
        for batch in batches:
            for text in batch.column(0):
                state.update(text.as_py().encode())
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([state.hexdigest()])], names=["fingerprint"])

    ranges = lines.repartitionByRange("path").sortWithinPartitions("path").select(F.monotonically_increasing_id().alias("at"), "line")
    pieces = written(ranges.mapInArrow(joined, "at long, text string"), "pieces")  # a piece is an Arrow batch of lines
    return pieces.repartition(1).sortWithinPartitions("at").select("text").mapInArrow(hashed, "fingerprint string").agg(F.max("fingerprint").alias("fingerprint"))


#: Shelves that paths are dealt to by their hash, and shelves to a case: neither grows with the table.
SHELVES, CASES = 4096, 64


def wide_fingerprint(inventory: DataFrame) -> DataFrame:
    """(fingerprint) of an inventory of any size, whatever its order: SHA-256 over the digests of cases, those over shelves, those over lines.

    The digests of a shelf's lines are added up, as four 64-bit numbers each, so a shelf is no list that grows.
    """
    line = F.concat_ws("\t", "path", "sha256", F.col("size_bytes").cast("string"))
    digest = inventory.select(F.sha2(line.cast("binary"), 256).alias("d"))
    words = [F.conv(F.substring("d", 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]
    shelf = F.conv(F.substring("d", 1, 3), 16, 10).cast("int")
    totals = digest.groupBy(shelf.alias("shelf")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(w).alias(f"s{i}") for i, w in enumerate(words)])
    text = F.concat_ws(":", F.col("shelf"), F.col("n"), *[F.col(f"s{i}") for i in range(4)])

    def folded(df: DataFrame, by: list, key: str) -> DataFrame:
        lines = F.transform(F.array_sort(F.collect_list(F.struct(key, "t"))), lambda x: x["t"])
        return df.groupBy(*by).agg(F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("t"))

    cases = folded(totals.withColumns({"t": F.sha2(text.cast("binary"), 256), "place": F.floor(F.col("shelf") / (SHELVES // CASES))}), ["place"], "shelf")
    return folded(cases, [], "place").select(F.col("t").alias("fingerprint"))


def artifact_diff(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """(path, problem): missing or extra artifacts."""
    e, o = expected.select("path", F.lit(1).alias("e")), observed.select("path", F.lit(1).alias("o"))
    return e.join(o, "path", "full_outer").filter("e is null or o is null").select("path", F.when(F.col("o").isNull(), "missing").otherwise("extra").alias("problem"))


def repeated_artifacts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
