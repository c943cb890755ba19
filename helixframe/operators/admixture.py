"""Ancestry proportions by supervised admixture: label frequencies and sample proportions estimated together.

Every round is one pass over the tiles. A tile, met by its variants' frequencies and its samples'
proportions, gives its share of both new ones and of the likelihood; the shares are added up by variant
block and by sample block. Both tables stay in Spark; the likelihood alone reaches the driver. Listed
calls are cut into squares first, so that few tiles need the same numbers.

EM takes thousands of rounds to settle. Newton steps take some hundreds: the shares are then gradients and
curvatures of each variant's frequencies and each sample's proportions, whose quadratic models are maximized
within their bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators import tiles
from helixframe.operators.tiles import SAMPLES, SQUARE, Tiles
from helixframe.plans.stored import dropped, written

#: Frequencies keep this far from 0 and 1.
EDGE = 1e-5


class Admixture(NamedTuple):
    proportions: DataFrame  # (sid, label, q)
    frequencies: DataFrame  # (vid, label, p)
    likelihoods: list[float]  # of each round's begin


def _added(parts: DataFrame, key: str) -> DataFrame:
    """(key, m): arrays of doubles, added up; a group is read as a stream."""

    def add(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | float = 0.0
        for batch in batches:
            for m in batch.column(batch.schema.get_field_index("m")):
                total = total + np.frombuffer(m.as_py(), "<f8")
        yield pa.RecordBatch.from_arrays([pa.array([keys[0].as_py()]), pa.array([total.tobytes()], pa.binary())], names=["at", "m"])

    add.__annotations__ = {"keys": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return parts.select(F.col("at"), "m").groupBy("at").applyInArrow(add, "at string, m binary").withColumnRenamed("at", key)


def _boxed(p: np.ndarray, slope: np.ndarray, curve: np.ndarray, sweeps: int = 20) -> np.ndarray:
    """Frequencies that raise each row's quadratic model, one label after another, within EDGE."""
    x, r = p.copy(), slope.copy()
    for a in [*range(p.shape[1])] * sweeps:
        h = curve[:, a, a]
        step = np.clip(x[:, a] + np.where(h > 0, r[:, a] / np.where(h > 0, h, 1), 0), EDGE, 1 - EDGE) - x[:, a]
        x[:, a] += step
        r -= curve[:, a] * step[:, None]
    return x


def _shared(q: np.ndarray, slope: np.ndarray, curve: np.ndarray, sweeps: int = 20) -> np.ndarray:
    """Proportions that raise each row's quadratic model: two labels at a time, one gives what the other takes."""
    x, r = q.copy(), slope.copy()
    for a, b in [(a, b) for a in range(q.shape[1]) for b in range(a)] * sweeps:
        h = curve[:, a, a] + curve[:, b, b] - 2 * curve[:, a, b]
        step = np.clip(np.where(h > 1e-12, (r[:, a] - r[:, b]) / np.where(h > 1e-12, h, 1), 0), -x[:, a], x[:, b])
        x[:, a] += step
        x[:, b] -= step
        r -= (curve[:, a] - curve[:, b]) * step[:, None]
    return x


def fit(t: Tiles, labels: DataFrame, rounds: int | None = 200, tolerance: float = 1e-7) -> Admixture:
    """Proportions of every sample in the labels (sid, label): those with a label are of it alone, the others start even.

    Rounds end when the likelihood rises by less than tolerance of itself: rounds of EM, so many at most, or
    with None Newton steps, as many as it takes.
    """
    sparse = t.sparse
    if sparse:
        t = tiles.squares(t)
    width = 1 << SQUARE if sparse else SAMPLES
    names = [r.label for r in labels.select("label").distinct().orderBy("label").collect()]  # a row per label
    k, hard, height = len(names), t.hard, t.height
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("label")) - 1
    known = t.samples.join(labels.select("sid", "label"), "sid", "left").select("sblock", "col", place.cast("int").alias("label"))

    def start(part: pa.Table) -> pa.Table:  # width rows at most
        q, fixed = np.full((width, k), 1 / k), np.zeros(width)
        for col, label in zip(part["col"].to_pylist(), part["label"].to_pylist(), strict=True):
            if label is not None:
                q[col], fixed[col] = np.eye(k)[label], 1
        return pa.table({"sblock": part["sblock"][:1], "q": pa.array([q.tobytes()], pa.binary()), "fixed": pa.array([fixed.tobytes()], pa.binary())})

    people = written(known.groupBy("sblock").applyInArrow(start, "sblock int, q binary, fixed binary"), "people")
    rows = t.tiles.select("block", "sblock", "tile")

    def added(at: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(at, c, size) for c in x.T], 1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = np.frombuffer(r["q"], "<f8").reshape(width, k) * np.frombuffer(r["fixed"], "<f8")[:, None]
                if sparse:
                    row, col, g = tiles.entries(r["tile"], SQUARE)
                    m = np.stack([added(row, g[:, None] * own[col], height), 2 * added(row, own[col], height)])
                else:
                    g, called = (x.astype(float) for x in tiles.unpack(r["tile"], hard))
                    m = np.stack([g @ own, 2 * called @ own])
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]]), pa.array([m.tobytes()], pa.binary())], names=["at", "m"])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, m in zip(batch.column(0), batch.column(1), strict=True):
                up, all_ = np.frombuffer(m.as_py(), "<f8").reshape(2, height, k)
                p = np.clip(np.where(all_ > 0, up / np.where(all_ > 0, all_, 1), 0.5), EDGE, 1 - EDGE)
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), pa.array([p.tobytes()], pa.binary())], names=["block", "p"])

    p = written(_added(rows.join(people, "sblock").mapInArrow(counted, "at string, m binary"), "block").mapInArrow(frequencies, "block string, p binary"), "frequencies")

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q, p = np.frombuffer(r["q"], "<f8").reshape(width, k), np.frombuffer(r["p"], "<f8").reshape(height, k)
                if sparse:
                    row, col, g = tiles.entries(r["tile"], SQUARE)
                    mine, theirs = q[col], p[row]
                    one, none = (theirs * mine).sum(1), ((1 - theirs) * mine).sum(1)
                    high, low = (g / one)[:, None], ((2 - g) / none)[:, None]
                    up, down = p * added(row, high * mine, height), (1 - p) * added(row, low * mine, height)
                    moved = np.hstack([q * added(col, high * theirs + low * (1 - theirs), width), 2 * np.bincount(col, minlength=width)[:, None]])
                    level = (g * np.log(one) + (2 - g) * np.log(none)).sum()
                else:
                    g, called = (x.astype(float) for x in tiles.unpack(r["tile"], hard))
                    one, none = p @ q.T, (1 - p) @ q.T
                    high, low = called * g / one, called * (2 - g) / none
                    up, down = p * (high @ q), (1 - p) * (low @ q)
                    moved = np.hstack([q * (high.T @ p + low.T @ (1 - p)), 2 * called.sum(0)[:, None]])
                    level = (called * (g * np.log(one) + (2 - g) * np.log(none))).sum()
                found = [(f"p{r['block']}", np.stack([up, up + down])), (f"q{r['sblock']}", moved), ("l", np.array([level]))]
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found]), pa.array([m.tobytes() for _, m in found], pa.binary())], names=["at", "m"])

    def proportions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                old, fixed = np.frombuffer(r["q"], "<f8").reshape(width, k), np.frombuffer(r["fixed"], "<f8")
                m = np.frombuffer(r["m"], "<f8").reshape(width, k + 1) if r["m"] is not None else np.zeros((width, k + 1))
                free = (fixed == 0) & (m[:, -1] > 0)
                q = np.where(free[:, None], m[:, :-1] / np.where(free, m[:, -1], 1)[:, None], old)
                yield pa.RecordBatch.from_arrays([pa.array([r["sblock"]], pa.int32()), pa.array([q.tobytes()], pa.binary()), pa.array([r["fixed"]], pa.binary())], names=["sblock", "q", "fixed"])

    pairs = [(a, b) for a in range(k) for b in range(a + 1)]
    square = np.array([[pairs.index((max(a, b), min(a, b))) for b in range(k)] for a in range(k)])

    def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Gradients and curvatures, a triangle of pairs of labels, by variant and by sample, and the likelihood."""
        for batch in batches:
            for r in batch.to_pylist():
                q, p = np.frombuffer(r["q"], "<f8").reshape(width, k), np.frombuffer(r["p"], "<f8").reshape(height, k)
                both = lambda x: np.stack([x[:, a] * x[:, b] for a, b in pairs], 1)
                if sparse:
                    row, col, g = tiles.entries(r["tile"], SQUARE)
                    mine, theirs = q[col], p[row]
                    one, none = (theirs * mine).sum(1), ((1 - theirs) * mine).sum(1)
                    high, low = (g / one)[:, None], ((2 - g) / none)[:, None]
                    up, down = high / one[:, None], low / none[:, None]
                    of = added(row, np.hstack([(high - low) * mine, (up + down) * both(mine)]), height)
                    moved = added(col, np.hstack([high * theirs + low * (1 - theirs), up * both(theirs) + down * both(1 - theirs)]), width)
                    level = (g * np.log(one) + (2 - g) * np.log(none)).sum()
                else:
                    g, called = (x.astype(float) for x in tiles.unpack(r["tile"], hard))
                    one, none = p @ q.T, (1 - p) @ q.T
                    high, low = called * g / one, called * (2 - g) / none
                    of = np.hstack([(high - low) @ q, (high / one + low / none) @ both(q)])
                    moved = np.hstack([high.T @ p + low.T @ (1 - p), (high / one).T @ both(p) + (low / none).T @ both(1 - p)])
                    level = (called * (g * np.log(one) + (2 - g) * np.log(none))).sum()
                found = [(f"p{r['block']}", of), (f"q{r['sblock']}", moved), ("l", np.array([level]))]
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found]), pa.array([m.tobytes() for _, m in found], pa.binary())], names=["at", "m"])

    def stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                kind = r["at"][0]
                if kind == "l":
                    new = np.frombuffer(r["m"], "<f8")
                else:
                    old = new = np.frombuffer(r["x"], "<f8").reshape(-1, k)
                    if r["m"] is not None:
                        m = np.frombuffer(r["m"], "<f8").reshape(-1, k + len(pairs))
                        new = (_boxed if kind == "p" else _shared)(old, m[:, :k], m[:, k:][:, square])
                    if kind == "q":
                        new = np.where(np.frombuffer(r["fixed"], "<f8")[:, None] > 0, old, new)
                yield pa.RecordBatch.from_arrays([pa.array([r["at"]]), pa.array([np.ascontiguousarray(new).tobytes()], pa.binary()), pa.array([r["fixed"]], pa.binary())], names=["at", "x", "fixed"])

    def halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x = (np.frombuffer(r["was"], "<f8") + np.frombuffer(r["x"], "<f8")) / 2
                yield pa.RecordBatch.from_arrays([pa.array([r["at"]]), pa.array([x.tobytes()], pa.binary()), pa.array([r["fixed"]], pa.binary())], names=["at", "x", "fixed"])

    def newton() -> tuple[DataFrame, DataFrame, list[float]]:
        """(p, people, likelihoods) where a step no longer raises the likelihood; a step that lowers it is halved.

        Both tables are one, (at, x, fixed), so that a round is one job: its result is the next one's table,
        with the likelihood of the one before.
        """
        schema = "at string, x binary, fixed binary"
        met = written(rows.select(F.concat(F.lit("p"), "block").alias("p_at"), F.concat(F.lit("q"), F.col("sblock").cast("string")).alias("q_at"), "tile", "block", "sblock"), "met", heavy=True)
        one = p.select(F.concat(F.lit("p"), "block").alias("at"), F.col("p").alias("x"), F.lit(None).cast("binary").alias("fixed"))
        now = written(one.unionByName(people.select(F.concat(F.lit("q"), F.col("sblock").cast("string")).alias("at"), F.col("q").alias("x"), "fixed")), "state", heavy=True)
        old, levels = None, []
        while True:
            frequency, share = now.filter("at like 'p%'").select(F.col("at").alias("p_at"), F.col("x").alias("p")), now.filter("at like 'q%'").select(F.col("at").alias("q_at"), F.col("x").alias("q"))
            summed = _added(met.join(frequency, "p_at").join(share, "q_at").select("block", "sblock", "tile", "p", "q").mapInArrow(slopes, "at string, m binary"), "at")
            after = written(now.filter("at <> 'l'").join(summed, "at", "full").select("at", "x", "fixed", "m").mapInArrow(stepped, schema), "state", heavy=True)
            row = after.filter("at = 'l'").first()
            level = float(np.frombuffer(row.x, "<f8")[0]) if row else 0.0
            rise = level - levels[-1] if levels else np.inf
            if not row or abs(rise) < tolerance * abs(level):
                kept = now if rise >= 0 else old
                levels.append(max(level, *levels[-1:]) if levels else level)
                return kept.filter("at like 'p%'").select(F.expr("substring(at, 2)").alias("block"), F.col("x").alias("p")), kept.filter("at like 'q%'").select(F.substring("at", 2, 20).cast("int").alias("sblock"), F.col("x").alias("q"), "fixed"), levels
            if rise < 0:
                middle = written(now.filter("at <> 'l'").join(old.select("at", F.col("x").alias("was")), "at").mapInArrow(halved, schema), "state", heavy=True)
                dropped(after, now)
                now = middle
            else:
                dropped(*([old] if old else []))
                old, now = now, after
                levels.append(level)

    levels: list[float] = []
    if rounds is None:
        p, people, levels = newton()
    for _ in range(rounds or 0):
        new = written(_added(rows.join(p, "block").join(people, "sblock").mapInArrow(shares, "at string, m binary"), "at"), "round")
        row = new.filter("at = 'l'").first()
        levels.append(float(np.frombuffer(row.m, "<f8")[0]) if row else 0.0)
        if len(levels) > 1 and levels[-1] - levels[-2] < tolerance * abs(levels[-1]) or not row:
            break
        mine = new.filter("at like 'q%'").select(F.substring("at", 2, 20).cast("int").alias("sblock"), "m")
        p = written(new.filter("at like 'p%'").select(F.expr("substring(at, 2)").alias("block"), "m").mapInArrow(frequencies, "block string, p binary"), "frequencies")
        people = written(people.join(mine, "sblock", "left").mapInArrow(proportions, "sblock int, q binary, fixed binary"), "people")

    def flat(name: str, key: str, size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, m in zip(batch.column(0), batch.column(1), strict=True):
                    x = np.frombuffer(m.as_py(), "<f8")
                    yield pa.RecordBatch.from_arrays([pa.array([at.as_py()] * size * k, batch.schema.field(0).type), pa.array(np.repeat(np.arange(size, dtype=np.int32), k)), pa.array(names * size), pa.array(x)], names=[key, "row", "label", name])

        return run

    of = people.select("sblock", "q").mapInArrow(flat("q", "sblock", width), "sblock int, row int, label string, q double")
    at = p.select("block", "p").mapInArrow(flat("p", "block", height), "block string, row int, label string, p double")
    return Admixture(
        t.samples.join(of.withColumnRenamed("row", "col"), ["sblock", "col"]).select("sid", "label", "q"), t.variants.join(at, ["block", "row"]).select("vid", "label", "p"), levels,
    )
