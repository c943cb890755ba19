"""The genotype matrix in tiles: VARIANTS neighbouring variants by SAMPLES samples, stored as binary rows.

Hard calls take two bits (0, 1, 2, and 3 for no call), dosages a 32-bit float (NaN for no call). What
compares variants with variants, or samples with samples, shuffles tiles and multiplies them as
matrices; a group of tiles is read as a stream, so a task holds two tiles and its sums, whatever the
number of samples or variants.

Where few pairs of a sample and a variant have a call, a tile is the list of its hard calls, four bytes
each, and WIDE samples wide: tables and work then grow with the calls, not with samples times variants.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.plans.order import placed
from helixframe.plans.stored import written

VARIANTS, SAMPLES = 128, 1024
#: Bits of a listed call's variant; samples and most variants of a tile of listed calls, and the share of pairs with a call below which calls are listed.
BITS, WIDE, SPARSE = 10, 1 << 20, 1 / 16
HIGH = 1 << BITS
#: Bits of a side of a square tile, see squares.
SQUARE = 13
#: Pairs of listed calls that are taken at a time.
CROSSED = 1 << 22
#: Bytes of tiles that a batch brings to a task.
BATCH_BYTES = 16 << 20
_CODES = np.array([[b >> s & 3 for s in (0, 2, 4, 6)] for b in range(256)], np.uint8)


class Tiles(NamedTuple):
    """tiles (block, sblock, vids, tile), variants (vid, chrom, pos, idx, block, row), samples (sid, sblock, col); hard: two-bit calls.

    idx is a variant's place on its chromosome, block the chromosome and idx // height. Samples are
    ordered by sid. sparse: a tile lists its calls and is WIDE samples wide, not SAMPLES.
    """

    tiles: DataFrame
    variants: DataFrame
    samples: DataFrame
    hard: bool
    height: int = VARIANTS
    sparse: bool = False

    @property
    def width(self) -> int:
        return WIDE if self.sparse else SAMPLES


def listed(row: np.ndarray, col: np.ndarray, g: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hard calls as sorted 32-bit numbers: column, row, call."""
    return np.sort(col.astype("<u4") << bits + 2 | row.astype("<u4") << 2 | g.astype("<u4"))


def entries(tile: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, col, g) of a tile of listed calls, ordered by column."""
    e = np.frombuffer(tile, "<u4").astype(np.int64)
    return e >> 2 & (1 << bits) - 1, e >> bits + 2, e & 3


def crossed(first: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of all j from first[i] up to end[i], about CROSSED pairs at a time."""
    n = np.maximum(end - first, 0)
    total = np.cumsum(n)
    begin = 0
    while begin < len(n):
        stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + CROSSED, "right")))
        own = n[begin:stop]
        i = np.repeat(np.arange(begin, stop), own)
        if len(i):
            yield i, np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(first[begin:stop], own)
        begin = stop


def pack(g: np.ndarray) -> bytes:
    """A tile of calls, 3 where there is none, a row a variant, of SAMPLES columns: four calls a byte, the first lowest."""
    four = g.reshape(len(g), -1, 4).astype(np.uint8)
    return (four[:, :, 0] | four[:, :, 1] << 2 | four[:, :, 2] << 4 | four[:, :, 3] << 6).tobytes()


def unpack(tile: bytes, hard: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(calls, 0 where there is none; 1 where there is one), as 32-bit floats."""
    if hard:
        code = _CODES[np.frombuffer(tile, np.uint8)].reshape(-1, SAMPLES)
        known = code != 3
        return np.where(known, code, 0).astype(np.float32), known.astype(np.float32)
    g = np.frombuffer(tile, "<f4").reshape(-1, SAMPLES)
    known = ~np.isnan(g)
    return np.where(known, g, 0), known.astype(np.float32)


def bound_batches(spark: SparkSession) -> None:
    """Bounds the bytes of Arrow batches, unless the session has a smaller bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = spark.conf.get(key).lower().rstrip("b")
    size = int(text.rstrip("kmg")) << {"k": 10, "m": 20, "g": 30}.get(text[-1:], 0) if text[:1] != "-" else 0
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def place_variants(variants: DataFrame, height: int = VARIANTS) -> DataFrame:
    """(vid, chrom, pos, idx, block, row) of variants (vid, chrom, pos), in the order of positions, ties by vid; blocks of height variants."""
    at = placed(variants.select("vid", "chrom", "pos").filter("chrom is not null"), ["chrom"], ["pos", "vid"], "idx")
    block = F.concat_ws(":", "chrom", F.expr(f"idx div {height}").cast("string"))
    return at.withColumns({"block": block, "row": (F.col("idx") % height).cast("int")})


def place_samples(samples: DataFrame, width: int = SAMPLES) -> DataFrame:
    """(sid, sblock, col) of samples (sid), in one window: ids alone, as many as people in a study."""
    at = samples.select("sid").filter("sid is not null").distinct().select("sid", (F.row_number().over(Window.orderBy("sid")) - 1).alias("idx"))
    return at.select("sid", F.expr(f"idx div {width}").cast("int").alias("sblock"), (F.col("idx") % width).cast("int").alias("col"))


def tiled(calls: DataFrame, variants: DataFrame | None = None, height: int = VARIANTS, listing: bool = True) -> Tiles:
    """The stored tiles of calls (sid, vid, g), of the variants (vid, chrom, pos), or of all, in the order of vid, if none are given.

    A pair that is called twice is an error. Calls are shuffled once, to their tile. Hard calls of less
    than SPARSE of all pairs are listed, unless listing is off.
    """
    spark = calls.sparkSession
    bound_batches(spark)
    if variants is None:
        variants = calls.select("vid").distinct().select("vid", F.lit("").alias("chrom"), F.lit(0).alias("pos"))
    hard = calls.schema["g"].dataType.typeName() in ("byte", "short", "integer", "long")
    at, people = written(place_variants(variants, height), "variants"), written(calls.select("sid").filter("sid is not null").distinct(), "people")
    sparse = listing and hard and height <= HIGH and calls.filter("g is not null").count() < SPARSE * at.count() * people.count()
    who = written(place_samples(people, WIDE if sparse else SAMPLES), "samples")
    kind = calls.schema["vid"].dataType.simpleString()
    rows = calls.filter("g is not null").join(at.select("vid", "block", "row"), "vid").join(who, "sid")
    shape = (height, SAMPLES)

    def build(table: pa.Table) -> pa.Table:  # a tile's calls
        row, col, g = (table[c].to_numpy() for c in ("row", "col", "g"))
        if hard and len(g) and not (g.min() >= 0 and g.max() <= 2):
            raise ValueError("hard calls are 0, 1 or 2")
        if sparse:
            cells = listed(row, col, g)
            twice = bool((cells[1:] >> 2 == cells[:-1] >> 2).any())
        else:
            cells = np.full(shape, 3, np.uint8) if hard else np.full(shape, np.nan, "<f4")
            cells[row, col] = g
            twice = np.count_nonzero(cells != 3 if hard else ~np.isnan(cells)) != len(g)
        if twice:
            raise ValueError("a sample has two calls of one variant")
        vids = [None] * height
        for r, v in zip(row.tolist(), table["vid"].to_pylist(), strict=True):
            vids[r] = v
        return pa.table({"block": table["block"][:1], "sblock": table["sblock"][:1], "vids": pa.array([vids], pa.list_(table.schema.field("vid").type)), "tile": pa.array([pack(cells) if hard and not sparse else cells.tobytes()], pa.binary())})

    cut = rows.select("block", "sblock", "row", "col", "vid", "g").groupBy("block", "sblock").applyInArrow(build, f"block string, sblock int, vids array<{kind}>, tile binary")
    return Tiles(written(cut, "tiles", heavy=height > VARIANTS), at, who, hard, height, sparse)


def squares(t: Tiles) -> Tiles:
    """Listed calls in stored tiles of up to 2**SQUARE variants by 2**SQUARE samples (block, sblock, tile), for what needs numbers of both sides."""
    per, height, side = (1 << SQUARE) // t.height, t.height, 1 << SQUARE

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                row, col, g = entries(r["tile"])
                chrom, _, at = r["block"].rpartition(":")
                row, col = row + int(at) % per * height, col + r["sblock"] * WIDE
                first = np.flatnonzero(np.r_[True, np.diff(col >> SQUARE) > 0])
                parts = [listed(row[a:b], col[a:b] & side - 1, g[a:b], SQUARE).tobytes() for a, b in zip(first, np.r_[first[1:], len(col)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([f"{chrom}:{int(at) // per}"] * len(first)), pa.array((col[first] >> SQUARE).astype(np.int32)), pa.array(parts, pa.binary())], names=["block", "sblock", "tile"])

    def joined(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = b"".join(b"".join(batch.column(batch.schema.get_field_index("tile")).to_pylist()) for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([tile], pa.binary())], names=["block", "sblock", "tile"])

    joined.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    schema = "block string, sblock int, tile binary"
    tiles = t.tiles.select("block", "sblock", "tile").mapInArrow(cut, schema).groupBy("block", "sblock").applyInArrow(joined, schema)
    at = F.col("sblock").cast("long") * WIDE + F.col("col")
    samples = t.samples.select("sid", F.floor(at / side).cast("int").alias("sblock"), (at % side).cast("int").alias("col"))
    tall = per * height
    variants = t.variants.withColumns({"block": F.concat_ws(":", "chrom", F.expr(f"idx div {tall}").cast("string")), "row": (F.col("idx") % tall).cast("int")})
    return Tiles(written(tiles, "squares"), variants, samples, True, tall, True)


def tasks(df: DataFrame) -> int:
    """Tasks of a step whose work is in its groups, not in their bytes: a number that adaptive execution leaves alone."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _correlations(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, r) by pair from sums of n, a, b, ab, aa and bb; r is NaN without variance."""
    n, sa, sb, sab, saa, sbb = sums
    va, vb = n * saa - sa * sa, n * sbb - sb * sb
    with np.errstate(divide="ignore", invalid="ignore"):
        return n, np.where((va > 0) & (vb > 0), (n * sab - sa * sb) / np.sqrt(va * vb), np.nan)


def _add_listed(sums: np.ndarray, one: bytes, other: bytes) -> None:
    """Adds the sums of n, a, b, ab, aa and bb of two tiles of listed calls: calls of a sample meet."""
    (ra, ca, ga), (rb, cb, gb) = entries(one), entries(other)
    size = VARIANTS * VARIANTS
    for i, j in crossed(np.searchsorted(cb, ca, "left"), np.searchsorted(cb, ca, "right")):
        at, x, y = ra[i] * VARIANTS + rb[j], ga[i], gb[j]
        for k, z in enumerate((None, x, y, x * y, x * x, y * y)):
            sums[k] += np.bincount(at, z, size).reshape(VARIANTS, VARIANTS)


def _scan(t: Tiles, wanted: DataFrame, mask: Callable[[str, str, bytes | None], np.ndarray], least: float | None) -> DataFrame:
    """(va, vb, i, j, a, b, n, r) of the pairs that mask(va, vb, bits) allows, of blocks wanted (va, vb, bits); r may be null.

    A pair of blocks is one group: its tiles come one sample block after another and are added up.
    With least, only pairs with r * r above it leave the task.
    """
    if t.height != VARIANTS:
        raise ValueError(f"variants are compared in tiles of {VARIANTS} of them")
    hard, sparse = t.hard, t.sparse
    kind = t.variants.schema["vid"].dataType.simpleString()
    a = t.tiles.select(F.col("block").alias("va"), "sblock", F.col("vids").alias("vids_a"), F.col("tile").alias("tile_a"))
    b = t.tiles.select(F.col("block").alias("vb"), "sblock", F.col("vids").alias("vids_b"), F.col("tile").alias("tile_b"))
    met = wanted.repartition(tasks(wanted), "va", "vb").join(a, "va").join(b, ["vb", "sblock"])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = key[0].as_py(), key[1].as_py()
        sums, bits = np.zeros((6, VARIANTS, VARIANTS)), None
        names: list[list] = [[None] * VARIANTS, [None] * VARIANTS]
        for batch in batches:
            for r in batch.select(["bits", "vids_a", "tile_a", "vids_b", "tile_b"]).to_pylist():
                if sparse:
                    _add_listed(sums, r["tile_a"], r["tile_b"])
                else:
                    ga, ca = unpack(r["tile_a"], hard)
                    gb, cb = unpack(r["tile_b"], hard)
                    for k, (x, y) in enumerate(((ca, cb), (ga, cb), (ca, gb), (ga, gb), (ga * ga, cb), (ca, gb * gb))):
                        sums[k] += x @ y.T
                bits = r["bits"]
                for known, seen in zip(names, (r["vids_a"], r["vids_b"]), strict=True):
                    known[:] = [k if k is not None else s for k, s in zip(known, seen, strict=True)]
        n, rho = _correlations(sums)
        keep = mask(va, vb, bits) & (n > 0)
        if least is not None:
            keep &= np.nan_to_num(rho) ** 2 > least
        i, j = np.nonzero(keep)
        type_ = batch.schema.field("vids_a").type.value_type
        rho = rho[i, j]
        yield pa.RecordBatch.from_arrays(
            [pa.array([va] * len(i), pa.string()), pa.array([vb] * len(i), pa.string()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([names[0][x] for x in i], type_), pa.array([names[1][x] for x in j], type_), pa.array(n[i, j].astype(np.int64)), pa.array(rho, mask=np.isnan(rho))],
            names=["va", "vb", "i", "j", "a", "b", "n", "r"],
        )

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return met.groupBy("va", "vb").applyInArrow(run, f"va string, vb string, i int, j int, a {kind}, b {kind}, n long, r double")


def pair_r2(t: Tiles, pairs: DataFrame) -> DataFrame:
    """pairs (a, b) with n, r and r2 over the samples called at both; pairs without such a sample are left out.

    The pairs of two blocks travel as one bitmap.
    """
    a = t.variants.select(F.col("vid").alias("a"), F.col("block").alias("va"), F.col("row").alias("ra"))
    b = t.variants.select(F.col("vid").alias("b"), F.col("block").alias("vb"), F.col("row").alias("rb"))
    bits = F.bitmap_construct_agg((F.col("ra") * VARIANTS + F.col("rb")).cast("long"))
    met = pairs.select("a", "b").join(a, "a").join(b, "b").repartition(tasks(pairs), "va", "vb")  # before the bitmaps, which adaptive execution would gather in few tasks
    wanted = met.groupBy("va", "vb").agg(bits.alias("bits"))

    def asked(va: str, vb: str, bits: bytes | None) -> np.ndarray:
        return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[: VARIANTS * VARIANTS].reshape(VARIANTS, VARIANTS).astype(bool)

    return _scan(t, wanted, asked, None).select("a", "b", "n", "r", (F.col("r") * F.col("r")).alias("r2"))


def window_r2(t: Tiles, window: int, step: int, least: float) -> DataFrame:
    """(chrom, k, i, j, a, b, n, r) of the pairs with r * r above least that share a window of so many variants.

    Windows begin at every step-th variant of a chromosome, k is the first that holds both; i < j are
    places on the chromosome. No table of pairs is made: blocks meet their next ones.
    """
    blocks = t.variants.select("chrom", F.expr(f"idx div {VARIANTS}").alias("at")).distinct()
    reach = -(-(window - 1) // VARIANTS)
    name = lambda c: F.concat_ws(":", "chrom", F.col(c).cast("string"))
    ahead = blocks.withColumn("to", F.explode(F.sequence(F.col("at"), F.col("at") + reach)))
    wanted = ahead.select(name("at").alias("va"), name("to").alias("vb"), F.lit(None).cast("binary").alias("bits"))

    def inside(va: str, vb: str, bits: bytes | None) -> np.ndarray:
        i = int(va.rpartition(":")[2]) * VARIANTS + np.arange(VARIANTS)[:, None]
        j = int(vb.rpartition(":")[2]) * VARIANTS + np.arange(VARIANTS)[None, :]
        return (i < j) & (first_window(j, window, step) * step <= i)

    at = F.substring_index("va", ":", -1).cast("long") * VARIANTS + F.col("i")
    to = F.substring_index("vb", ":", -1).cast("long") * VARIANTS + F.col("j")
    k = F.greatest(F.lit(0), F.ceil((F.col("j") - (window - 1)) / step)).cast("long")
    chrom = F.expr("substring(va, 1, length(va) - length(substring_index(va, ':', -1)) - 1)")
    found = _scan(t, wanted, inside, least).select(chrom.alias("chrom"), at.alias("i"), to.alias("j"), "a", "b", "n", "r")
    return found.select("chrom", k.alias("k"), "i", "j", "a", "b", "n", "r")


def first_window(j: np.ndarray, window: int, step: int) -> np.ndarray:
    """The first of the windows, which begin at multiples of step, that reaches place j."""
    return np.maximum(0, -(-(j - (window - 1)) // step))


def _meetings(t: Tiles) -> DataFrame:
    """(sa, sb, met): by pair of SAMPLES samples each the pairs of listed calls of one variant, as 32-bit numbers: two columns, two calls.

    Their number is that of the pairs of samples called at a variant, added up over variants.
    """
    a = t.tiles.select("block", F.col("sblock").alias("sa"), F.col("tile").alias("tile_a"))
    b = t.tiles.select("block", F.col("sblock").alias("sb"), F.col("tile").alias("tile_b"))
    met = a.join(b, "block").filter("sa <= sb")

    def sent(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        place, met = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(place, kind="stable")
        place, data = place[order], met[order].astype("<u4").tobytes()
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        ends = np.r_[first, len(place)].astype("<i4") * 4
        of = place[first]
        return pa.RecordBatch.from_arrays([pa.array((of >> 32).astype(np.int32)), pa.array((of & 0xFFFFFFFF).astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])], names=["sa", "sb", "met"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                sides = []
                for tile, sblock in ((r["tile_a"], r["sa"]), (r["tile_b"], r["sb"])):
                    row, col, g = entries(tile)
                    order = np.argsort(row, kind="stable")  # by variant, then by sample
                    sides.append((row[order], col[order] + sblock * WIDE, g[order]))
                (ra, ca, ga), (rb, cb, gb) = sides
                first = np.arange(1, len(ra) + 1) if r["sa"] == r["sb"] else np.searchsorted(rb, ra, "left")
                for i, j in crossed(first, np.searchsorted(rb, ra, "right")):
                    x, y = ca[i], cb[j]
                    parts.append((x // SAMPLES << 32 | y // SAMPLES, x % SAMPLES << 14 | y % SAMPLES << 4 | ga[i] << 2 | gb[j]))
                    n += len(i)
                    if n >= CROSSED:
                        yield sent(parts)
                        parts, n = [], 0
        if parts:
            yield sent(parts)

    spread = met.repartition(tasks(met), "block")  # before the pairs, which adaptive execution would make in few tasks
    return spread.mapInArrow(run, "sa int, sb int, met binary")


def kinship(t: Tiles, above: float | None = None) -> DataFrame:
    """KING-robust (a, b, n, hethet, ibs0, het_a, het_b, phi) of sample pairs a < b, over variants called in both; with above, those of a larger phi.

    A pair of sample blocks is one group: its tiles come one variant block after another and are added up.
    Of listed calls only those meet that are of one variant.
    """
    if not t.hard:
        raise ValueError("kinship is of hard calls")
    sparse = t.sparse
    if sparse:
        met = _meetings(t)
        met = met.repartition(tasks(met), "sa", "sb")
    else:
        a = t.tiles.select("block", F.col("sblock").alias("sa"), F.col("tile").alias("tile_a"))
        b = t.tiles.select("block", F.col("sblock").alias("sb"), F.col("tile").alias("tile_b"))
        met = a.join(b, "block").filter("sa <= sb")
    counts = ["n", "hethet", "ibs0", "het_a", "het_b"]

    def add_listed(sums: np.ndarray, batch: pa.RecordBatch) -> None:
        e = np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("met")).to_pylist()), "<u4")
        at, ga, gb = e >> 4, e >> 2 & 3, e & 3
        for k, chosen in enumerate((slice(None), (ga == 1) & (gb == 1), (ga ^ gb) == 2, ga == 1, gb == 1)):
            sums[k] += np.bincount(at[chosen], minlength=SAMPLES * SAMPLES).reshape(SAMPLES, SAMPLES).astype(np.int32)

    def add_tiles(sums: np.ndarray, batch: pa.RecordBatch, same: bool) -> None:
        for one, other in zip(batch.column(batch.schema.get_field_index("tile_a")), batch.column(batch.schema.get_field_index("tile_b")), strict=True):
            (ga, ca), (gb, cb) = unpack(one.as_py()), unpack(other.as_py())
            het_a, het_b = (ga == 1).astype(np.float32), (gb == 1).astype(np.float32)
            none_a, none_b, both_a, both_b = ca * (ga == 0), cb * (gb == 0), (ga == 2).astype(np.float32), (gb == 2).astype(np.float32)
            apart, het = none_a.T @ both_b, het_a.T @ cb
            # of the same block the products the other way round are these, transposed
            for k, x in enumerate((ca.T @ cb, het_a.T @ het_b, apart + (apart.T if same else both_a.T @ none_b), het, het.T if same else ca.T @ het_b)):
                sums[k] += x.astype(np.int32)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sa, sb = key[0].as_py(), key[1].as_py()
        sums = np.zeros((5, SAMPLES, SAMPLES), np.int32)
        for batch in batches:
            if sparse:
                add_listed(sums, batch)
            else:
                add_tiles(sums, batch, sa == sb)
        for begin in range(0, SAMPLES, 64):  # a strip at a time
            n, hethet, ibs0, het_a, het_b = sums[:, begin : begin + 64].astype(np.int64)
            low = np.minimum(het_a, het_b)
            with np.errstate(divide="ignore", invalid="ignore"):
                phi = np.where(low > 0, (hethet - 2 * ibs0) / (2 * low) + 0.5 - (het_a + het_b) / (4 * low), np.nan)
            keep = n > 0
            if sa == sb:
                keep &= np.arange(SAMPLES)[None, :] > begin + np.arange(len(n))[:, None]
            if above is not None:
                keep &= np.nan_to_num(phi, nan=-np.inf) > above
            i, j = np.nonzero(keep)
            if len(i):
                phi = phi[i, j]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), sa, np.int32)), pa.array((i + begin).astype(np.int32)), pa.array(np.full(len(i), sb, np.int32)), pa.array(j.astype(np.int32)), *[pa.array(x[i, j]) for x in (n, hethet, ibs0, het_a, het_b)], pa.array(phi, mask=np.isnan(phi))], names=["sa", "ca", "sb", "cb", *counts, "phi"])

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    found = met.groupBy("sa", "sb").applyInArrow(run, "sa int, ca int, sb int, cb int, " + ", ".join(f"{c} long" for c in counts) + ", phi double")
    narrow = (WIDE if sparse else SAMPLES) // SAMPLES
    sblock = (F.col("sblock") * narrow + F.floor(F.col("col") / SAMPLES)).cast("int")
    people = t.samples.select("sid", sblock.alias("s"), (F.col("col") % SAMPLES).alias("c"))
    one = people.select(F.col("sid").alias("a"), F.col("s").alias("sa"), F.col("c").alias("ca"))
    other = people.select(F.col("sid").alias("b"), F.col("s").alias("sb"), F.col("c").alias("cb"))
    return found.join(one, ["sa", "ca"]).join(other, ["sb", "cb"]).select("a", "b", *counts, "phi")

