"""Products of the standardised genotype matrix of strata with a few vectors, for principal components.

Calls are stored once in pieces: whole variants of one stratum, in order; a part is a range of them and
belongs to one task. A round brings each task the vectors of the samples called in its part, in chunks of
neighbouring samples, streams its pieces past them and adds up the products by chunk. So a call is never a
row of a round, and nothing of a variant leaves its task. Where samples are many, a task takes some of the
vectors only, and a part has several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators import tiles
from helixframe.operators.admixture import _added
from helixframe.plans.order import placed
from helixframe.plans.stored import written

#: Samples of a chunk; calls of a piece, unless one variant has more; calls of a part at most, about, and ranges that it is sorted in; bytes of vectors in a task.
CHUNK, PIECE, PART, SPLIT, HELD = 1024, 1 << 19, 1 << 24, 4, 256 << 20
#: Calls that are worth a task.
LEAST = 1 << 16


class Matrix(NamedTuple):
    """pieces (part, s, vids, p, called, at, g), people (s, chunk, sids, m, gram) with the vectors to begin with, needs (part, s, chunk), strata (s, stratum).

    called are numbers of calls by variant, at places of samples in their stratum. A vector chunk m has
    width rows of CHUNK samples, and one more for their numbers of calls; gram is m's rows by each other.
    """

    pieces: DataFrame
    people: DataFrame
    needs: DataFrame
    strata: DataFrame
    width: int
    parts: int
    lanes: int


def _numbers(df: DataFrame, column: str) -> dict[int, np.ndarray]:
    """The sums of column, an array, by stratum: arrays as small as the number of vectors by itself."""
    return {int(r.s): np.frombuffer(r.m, "<f8") for r in _added(df.select(F.col("s").cast("string").alias("at"), F.col(column).alias("m")), "s").collect()}  # a row per stratum


def matrix(calls: DataFrame, members: DataFrame, width: int) -> Matrix:
    """The stored pieces of calls (sid, vid, g) of members (stratum, sid). Calls are shuffled twice: to their samples, then to ranges of variants.

    Variants without variance within the stratum go. Calls without a sample or a variant are none. Members are
    found once and stored, as they may come from the calls.
    """
    spark = calls.sparkSession
    tiles.bound_batches(spark)
    members = written(members.select("stratum", "sid"), "members")
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((members, "stratum"), (calls, "sid"), (calls, "vid"))}
    labels = [r.stratum for r in members.select("stratum").distinct().orderBy("stratum").collect()]  # a row per stratum
    strata = spark.createDataFrame(list(enumerate(labels)), f"s int, stratum {kinds['stratum']}")
    coded = members.select("stratum", F.col("sid").try_cast(kinds["sid"]).alias("sid")).filter("sid is not null").join(F.broadcast(strata), "stratum").select("s", "sid")
    who = written(placed(coded.distinct(), ["s"], ["sid"], "at"), "samples")
    known = calls.filter("g is not null and sid is not null and vid is not null").select("sid", "vid", F.col("g").cast("double").alias("g"))
    n, cores, side, most = known.count(), spark.sparkContext.defaultParallelism, CHUNK, PIECE
    parts = min(cores * max(1, -(-n // (PART * cores))), 1 + n // LEAST)
    lanes = -(-(width + 1) // max(1, HELD // (16 * max(1, who.count()))))

    def start(part: pa.Table) -> pa.Table:  # CHUNK rows at most
        m = np.zeros((width + 1, side))
        m[:width, part["at"].to_numpy() % side] = part["v"].combine_chunks().flatten().to_numpy().reshape(-1, width).T
        sids = [None] * side
        for at, sid in zip((part["at"].to_numpy() % side).tolist(), part["sid"].to_pylist(), strict=True):
            sids[at] = sid
        return pa.table({"s": part["s"][:1], "chunk": part["chunk"][:1], "sids": pa.array([sids], pa.list_(part.schema.field("sid").type)), "m": pa.array([m.tobytes()], pa.binary()), "gram": pa.array([(m[:width] @ m[:width].T).tobytes()], pa.binary())})

    begin = F.array(*[F.xxhash64("sid", F.lit(i)) / float(1 << 63) for i in range(width)])
    chunked = who.select("s", F.expr(f"at div {side}").cast("int").alias("chunk"), "at", "sid", begin.alias("v"))
    people = written(chunked.groupBy("s", "chunk").applyInArrow(start, f"s int, chunk int, sids array<{kinds['sid']}>, m binary, gram binary"), "people")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(table: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:  # of whole variants, which begin at first
            s, at, g, vid = table["s"].to_numpy(), table["at"].to_numpy(), table["g"].to_numpy(), table["vid"]
            called = np.diff(np.r_[first, len(s)])
            p = np.add.reduceat(g, first) / (2 * called)
            of, varied = s[first], (p > 0) & (p < 1)
            for own in np.unique(of):
                mine = varied & (of == own)
                if not mine.any():
                    continue
                rows = np.repeat(mine, called)
                x, where = g[rows], at[rows]
                with np.errstate(invalid="ignore"):
                    small = x.astype(np.uint8)
                x = small if (small == x).all() else x
                chunks = np.unique(where // side).astype(np.int32)
                values = [table["part"][:1].combine_chunks(), pa.array([own], pa.int32()), pa.array([vid.take(pa.array(first[mine])).to_pylist()], pa.list_(vid.type))]
                values += [pa.array([v.tobytes()], pa.binary()) for v in (p[mine], called[mine].astype("<u4"), where.astype("<u4"), x)]
                yield pa.RecordBatch.from_arrays([*values, pa.array([chunks], pa.list_(pa.int32()))], names=["part", "s", "vids", "p", "called", "at", "g", "chunks"])

        def starts(table: pa.Table) -> np.ndarray:
            other = pc.or_(pc.not_equal(table["s"][1:], table["s"][:-1]), pc.not_equal(table["vid"][1:], table["vid"][:-1]))
            return np.r_[0, np.flatnonzero(other.to_numpy()) + 1]

        held, n, bound = [], 0, most
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= bound:
                table = pa.Table.from_batches(held).combine_chunks()
                first = starts(table)
                end = int(first[-1])  # the last variant may go on
                if end:
                    yield from pieces(table.slice(0, end), first[:-1])
                held, n = table.slice(end).to_batches(), n - end
                bound = n + most
        if n:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from pieces(table, starts(table))

    rows = known.join(coded.join(who, ["s", "sid"]), "sid").select("s", "at", "vid", "g").repartitionByRange(parts * SPLIT, "s", "vid").sortWithinPartitions("s", "vid")
    part = F.least(F.expr(f"spark_partition_id() div {SPLIT}"), F.lit(parts - 1)).cast("int")
    cells = written(rows.withColumn("part", part).mapInArrow(cut, f"part int, s int, vids array<{kinds['vid']}>, p binary, called binary, at binary, g binary, chunks array<int>"), "pieces")
    needs = written(cells.select("part", "s", F.explode("chunks").alias("chunk")).distinct(), "needs")
    return Matrix(cells.drop("chunks"), people, needs, strata, width, parts, lanes)


def _met(x: Matrix, vectors: DataFrame, names: bool = False) -> DataFrame:
    """The rows of each task, a partition: its chunks of vectors (s, chunk, m), then its pieces."""
    lanes = F.explode(F.sequence(F.lit(0), F.lit(x.lanes - 1))).alias("lane")
    task = (F.col("part") * x.lanes + F.col("lane")).alias("task")
    chunks = x.needs.join(vectors.select("s", "chunk", "m"), ["s", "chunk"]).select("*", lanes).select(task, "lane", "s", "chunk", "m")
    pieces = x.pieces.select("*", lanes).select(task, "lane", "s", *(["vids"] if names else []), "p", "called", "at", "g")
    return chunks.unionByName(pieces, allowMissingColumns=True).repartitionById(x.parts * x.lanes, "task").sortWithinPartitions(F.col("m").isNull())


class _Task:
    """What a task has: vectors low to high of its samples' chunks, times their stratum's matrix, and the rows of each piece."""

    def __init__(self, turns: dict[int, np.ndarray], lanes: int, side: int, extra: int) -> None:
        self.turns, self.lanes, self.side, self.extra = turns, lanes, side, extra
        self.place: dict[tuple[int, int], int] = {}
        self.low = self.high = 0
        self.q: np.ndarray | None = None
        self.kind: pa.DataType | None = None

    def pieces(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(piece, its calls' columns of q, their variants, each variant's first call, standardised calls)."""
        held, tables = [], {}
        for batch in batches:
            if "vids" in batch.schema.names:
                self.kind = batch.schema.field("vids").type.value_type
            for r in batch.to_pylist():
                if r["m"] is not None:
                    turn = self.turns[r["s"]]
                    every = turn.shape[1] + self.extra
                    self.low, self.high = (every * i // self.lanes for i in (r["lane"], r["lane"] + 1))
                    self.place[r["s"], r["chunk"]] = len(held)
                    held.append(turn[:, self.low : self.high].T @ np.frombuffer(r["m"], "<f8").reshape(-1, self.side)[: len(turn)])
                    continue
                if self.q is None:
                    self.q = np.concatenate(held, 1)
                    held.clear()
                    for s in {s for s, _ in self.place}:
                        own = {c: i for (t, c), i in self.place.items() if t == s}
                        tables[s] = np.zeros(max(own) + 1, np.int64)
                        tables[s][list(own)] = list(own.values())
                p, called, at = np.frombuffer(r["p"], "<f8"), np.frombuffer(r["called"], "<u4").astype(np.int64), np.frombuffer(r["at"], "<u4").astype(np.int64)
                g = np.frombuffer(r["g"], np.uint8 if len(r["g"]) == len(at) else "<f8")
                row = np.repeat(np.arange(len(p)), called)
                z = (g - 2 * p[row]) / np.sqrt(2 * p * (1 - p))[row]
                yield r, tables[r["s"]][at // self.side] * self.side + at % self.side, row, np.cumsum(called) - called, z


def product(x: Matrix, vectors: DataFrame, turns: dict[int, np.ndarray]) -> DataFrame:
    """(s, chunk, m, gram): the matrix, samples by variants, times its transpose times vectors, these times their stratum's turn; stored."""
    width, lanes, side = x.width, x.lanes, CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, y = _Task(turns, lanes, side, 1), None
        for _, col, row, first, z in task.pieces(batches):
            if y is None:
                y = np.zeros((task.high - task.low, task.q.shape[1]))
            for j in range(len(y)):
                if task.low + j == width:
                    y[j] += np.bincount(col, minlength=y.shape[1])
                else:
                    y[j] += np.bincount(col, np.add.reduceat(z * task.q[j][col], first)[row] * z, y.shape[1])
        for (s, chunk), i in task.place.items() if y is not None else ():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([chunk], pa.int32()), pa.array([task.low], pa.int32()), pa.array([y[:, i * side : (i + 1) * side].tobytes()], pa.binary())], names=["s", "chunk", "low", "m"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, side))
        for batch in batches:
            for r in batch.to_pylist():
                m = np.frombuffer(r["m"], "<f8").reshape(-1, side)
                total[r["low"] : r["low"] + len(m)] += m
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([(total[:width] @ total[:width].T).tobytes()], pa.binary())], names=["s", "chunk", "m", "gram"])

    add.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    shares = _met(x, vectors).mapInArrow(run, "s int, chunk int, low int, m binary")
    return written(shares.groupBy("s", "chunk").applyInArrow(add, "s int, chunk int, m binary, gram binary"), "vectors")


def spanning(x: Matrix, vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each stratum the matrix that makes its vectors of length one and at right angles; directions without length become 0."""
    out = {}
    for s, gram in _numbers(vectors, "gram").items():
        values, turn = np.linalg.eigh(gram.reshape(x.width, x.width))
        some = values > 1e-10 * max(values.max(initial=0), 1e-300)
        out[s] = turn * np.where(some, 1 / np.sqrt(np.where(some, values, 1)), 0)
    return out


def crossed(x: Matrix, one: DataFrame, other: DataFrame) -> dict[int, np.ndarray]:
    """By stratum the products of the vectors of one with those of other."""
    width, side = x.width, CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a, b = (np.frombuffer(r[c], "<f8").reshape(-1, side)[:width] for c in ("m", "other"))
                yield pa.RecordBatch.from_arrays([pa.array([r["s"]], pa.int32()), pa.array([(a @ b.T).tobytes()], pa.binary())], names=["s", "x"])

    met = one.select("s", "chunk", "m").join(other.select("s", "chunk", F.col("m").alias("other")), ["s", "chunk"])
    return {s: v.reshape(width, width) for s, v in _numbers(met.select("s", "m", "other").mapInArrow(run, "s int, x binary"), "x").items()}


def cubes(vectors: DataFrame, turns: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """By stratum the sums of cubes of each vector, after the turn."""
    side = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                turn = turns[r["s"]]
                q = turn.T @ np.frombuffer(r["m"], "<f8").reshape(-1, side)[: len(turn)]
                yield pa.RecordBatch.from_arrays([pa.array([r["s"]], pa.int32()), pa.array([(q**3).sum(1).tobytes()], pa.binary())], names=["s", "x"])

    return _numbers(vectors.select("s", "m").mapInArrow(run, "s int, x binary"), "x")


def by_sample(x: Matrix, vectors: DataFrame, turns: dict[int, np.ndarray], counts: dict[int, int]) -> DataFrame:
    """(stratum, sid, pc, score) of the samples with calls: vectors after the turn, the first of them, by their stratum's count."""
    side, kind = CHUNK, x.people.schema["sids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column(batch.schema.get_field_index("sids"))
            for i, r in enumerate(batch.select(["s", "m"]).to_pylist()):
                turn, m = turns[r["s"]], np.frombuffer(r["m"], "<f8").reshape(-1, side)
                some = np.flatnonzero(m[-1] > 0)
                q, own = turn.T @ m[: len(turn)][:, some], sids[i].values.take(pa.array(some))
                for j, score in enumerate(q[: counts[r["s"]]]):
                    yield pa.RecordBatch.from_arrays([pa.array([r["s"]] * len(some), pa.int32()), own, pa.array([f"PC{j + 1}"] * len(some)), pa.array(score)], names=["s", "sid", "pc", "score"])

    met = vectors.select("s", "chunk", "m").join(x.people.select("s", "chunk", "sids"), ["s", "chunk"]).select("s", "sids", "m")
    return met.mapInArrow(run, f"s int, sid {kind}, pc string, score double").join(F.broadcast(x.strata), "s").select("stratum", "sid", "pc", "score")  # a row per stratum


def by_variant(x: Matrix, vectors: DataFrame, turns: dict[int, np.ndarray], counts: dict[int, int]) -> DataFrame:
    """(stratum, vid, pc, w): the transposed matrix times vectors after the turn, the first of them, by their stratum's count."""
    lanes, side, kind = x.lanes, CHUNK, x.pieces.schema["vids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _Task(turns, lanes, side, 0)
        for r, col, _, first, z in task.pieces(batches):
            for j in range(min(task.high, counts[r["s"]]) - task.low):
                w = np.add.reduceat(z * task.q[j][col], first)
                yield pa.RecordBatch.from_arrays([pa.array([r["s"]] * len(w), pa.int32()), pa.array(r["vids"], task.kind), pa.array([f"PC{task.low + j + 1}"] * len(w)), pa.array(w)], names=["s", "vid", "pc", "w"])

    return _met(x, vectors, names=True).mapInArrow(run, f"s int, vid {kind}, pc string, w double").join(F.broadcast(x.strata), "s").select("stratum", "vid", "pc", "w")  # a row per stratum


def frequencies(x: Matrix) -> DataFrame:
    """(stratum, vid, p) of the variants in the matrix."""
    kind = x.pieces.schema["vids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vids = batch.column(batch.schema.get_field_index("vids"))
            for i, r in enumerate(batch.select(["s", "p"]).to_pylist()):
                p = np.frombuffer(r["p"], "<f8")
                yield pa.RecordBatch.from_arrays([pa.array([r["s"]] * len(p), pa.int32()), vids[i].values, pa.array(p)], names=["s", "vid", "p"])

    return x.pieces.select("s", "vids", "p").mapInArrow(run, f"s int, vid {kind}, p double").join(F.broadcast(x.strata), "s").select("stratum", "vid", "p")  # a row per stratum
