"""Variant-major BED files as a Spark data source whose tasks read ranges of bytes.

A row is a strip: one variant's calls of up to SAMPLES samples, two bits each, as tiles hold them. So
what is shuffled into tiles, or decoded to calls, has a quarter byte a call, and a file of any size is
read by as many tasks as it has ranges. Files are opened by URI through Arrow's file systems.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from helixframe.operators import tiles
from helixframe.operators.tiles import SAMPLES, VARIANTS, Tiles
from helixframe.plans.ship import ship
from helixframe.plans.stored import written

MAGIC = b"\x6c\x1b\x01"
#: Bytes of the file that a task reads, and that it holds at a time.
RANGE_BYTES, CHUNK_BYTES = 32 << 20, 4 << 20
# Fixed values of the format: 00 two first alleles, 01 no call, 10 one, 11 none; tiles write no call as 3.
_CODE = np.array([2, 3, 1, 0], np.uint8)
_AS_TILE = np.array([sum(int(_CODE[b >> s & 3]) << s for s in (0, 2, 4, 6)) for b in range(256)], np.uint8)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


class Range(InputPartition):
    def __init__(self, first: int, variants: int):
        self.first, self.variants = first, variants


class BedReader(DataSourceReader):
    def __init__(self, path: str, n: int, m: int, range_bytes: int):
        self.path, self.n, self.m, self.range_bytes, self.width = path, n, m, range_bytes, (n + 3) // 4

    def check(self) -> None:
        system, at = opened(self.path)
        size = system.get_file_info(at).size
        with system.open_input_file(at) as f:
            magic = f.read_at(3, 0) if size and size > 3 else b""
        if magic != MAGIC or size != 3 + self.width * self.m:
            raise ValueError(f"{self.path} isn't a variant-major BED file of {self.m} variants and {self.n} samples")

    def partitions(self) -> list[InputPartition]:
        self.check()
        each = max(1, self.range_bytes // self.width)
        return [Range(i, min(each, self.m - i)) for i in range(0, self.m, each)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, at = opened(self.path)
        strip, strips = SAMPLES // 4, -(-self.n // SAMPLES)
        each = max(1, CHUNK_BYTES // self.width)
        with system.open_input_file(at) as f:
            for begin in range(part.first, part.first + part.variants, each):
                rows = min(each, part.first + part.variants - begin)
                raw = np.frombuffer(f.read_at(rows * self.width, 3 + begin * self.width), np.uint8).reshape(rows, self.width)
                cells = np.full((rows, strips * strip), 255, np.uint8)
                cells[:, : self.width] = _AS_TILE[raw]
                if self.n % 4:  # what the last byte has beyond the samples is no call
                    cells[:, self.width - 1] |= np.uint8(255 << 2 * (self.n % 4) & 255)
                data = pa.py_buffer(cells.tobytes())
                ends = pa.py_buffer(np.arange(0, rows * strips * strip + 1, strip, dtype="<i4").tobytes())
                vid, sblock = np.repeat(np.arange(begin, begin + rows), strips), np.tile(np.arange(strips, dtype=np.int32), rows)
                yield pa.RecordBatch.from_arrays([pa.array(vid), pa.array(sblock), pa.Array.from_buffers(pa.binary(), rows * strips, [None, ends, data])], names=["vid", "sblock", "strip"])


class BedSource(DataSource):
    """Options: path (the .bed file), samples, variants and rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "helix_bed"

    def schema(self) -> str:
        return "vid long, sblock int, strip binary"

    def reader(self, schema) -> BedReader:
        o = self.options
        return BedReader(o["path"], int(o["samples"]), int(o["variants"]), int(o.get("rangeBytes", RANGE_BYTES)))


def _sizes(spark: SparkSession, prefix: str) -> tuple[int, int]:
    lines = lambda end: spark.read.text(f"{prefix}.{end}").filter(F.trim("value") != "").count()
    return lines("fam"), lines("bim")


def read_strips(spark: SparkSession, prefix: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(vid, sblock, strip) of a BED file; vid counts rows of the BIM file, samples rows of the FAM file, from 0."""
    ship(spark)
    tiles.bound_batches(spark)
    n, m = _sizes(spark, prefix)
    if not n or not m:
        return spark.createDataFrame([], "vid long, sblock int, strip binary")
    BedReader(f"{prefix}.bed", n, m, range_bytes).check()
    spark.dataSource.register(BedSource)
    options = {"path": f"{prefix}.bed", "samples": str(n), "variants": str(m), "rangeBytes": str(range_bytes)}
    return spark.read.format("helix_bed").options(**options).load()


def read_bed(spark: SparkSession, prefix: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(vid, sid, g): the calls of a BED file, decoded where they are read; g counts first (A1) alleles, null without a call."""
    n = _sizes(spark, prefix)[0]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = max(1, (1 << 20) // SAMPLES)
            for begin in range(0, batch.num_rows, each):
                part = batch.slice(begin, each)
                code = tiles._CODES[np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8)].reshape(part.num_rows, SAMPLES).astype(np.int32)
                sid = part.column(1).to_numpy().astype(np.int64)[:, None] * SAMPLES + np.arange(SAMPLES)
                real = sid < n
                vid = np.broadcast_to(part.column(0).to_numpy()[:, None], sid.shape)
                g = code[real]
                yield pa.RecordBatch.from_arrays([pa.array(vid[real]), pa.array(sid[real]), pa.array(g, mask=g == 3)], names=["vid", "sid", "g"])

    return read_strips(spark, prefix, range_bytes).mapInArrow(decode, "vid long, sid long, g int")


def read_tiles(spark: SparkSession, prefix: str, variants: DataFrame, range_bytes: int = RANGE_BYTES) -> Tiles:
    """The tiles of a BED file of variants (vid, chrom, pos), vid being the row of the BIM file; strips are shuffled, never calls."""
    at = written(tiles.place_variants(variants), "variants")
    n = _sizes(spark, prefix)[0]
    who = spark.range(n).select(F.col("id").alias("sid"), F.expr(f"int(id div {SAMPLES})").alias("sblock"), (F.col("id") % SAMPLES).cast("int").alias("col"))
    rows = read_strips(spark, prefix, range_bytes).join(at.select("vid", "block", "row"), "vid")

    def build(table: pa.Table) -> pa.Table:  # a tile's strips
        cells, vids = np.full((VARIANTS, SAMPLES // 4), 255, np.uint8), [None] * VARIANTS
        for r, v, s in zip(table["row"].to_pylist(), table["vid"].to_pylist(), table["strip"].to_pylist(), strict=True):
            cells[r] = np.frombuffer(s, np.uint8)
            vids[r] = v
        return pa.table({"block": table["block"][:1], "sblock": table["sblock"][:1], "vids": pa.array([vids], pa.list_(pa.int64())), "tile": pa.array([cells.tobytes()], pa.binary())})

    cut = rows.select("block", "sblock", "row", "vid", "strip").groupBy("block", "sblock").applyInArrow(build, "block string, sblock int, vids array<bigint>, tile binary")
    return Tiles(written(cut, "tiles"), at, who, True)
