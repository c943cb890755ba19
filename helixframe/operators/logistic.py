"""Logistic association of all variants of a tile at once: Newton steps, or Firth's, as products of matrices.

The tiles of a variant block are one group. Its packed calls and the samples' covariates are held, two
bits and a few doubles a sample; every step unpacks one sample block after another and adds up the
gradients and curvatures of all variants, then solves their small systems together. Listed calls take
the samples' numbers with them; steps then go over the calls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators import tiles
from helixframe.operators.tiles import Tiles
from helixframe.plans.stored import written

#: Largest step of a coefficient, and the size of an effect that counts as divergence.
STEP, DIVERGED = 2.0, 12.0


def packed_people(samples: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """(sblock, cols, m): of each sample block the places of the samples of rows (sid, columns...), and their numbers, as bytes."""

    def pack(part: pa.Table) -> pa.Table:  # SAMPLES rows at most
        part = part.sort_by("col")
        m = np.column_stack([part[c].to_numpy() for c in columns]).astype("<f8")
        return pa.table({"sblock": part["sblock"][:1], "cols": pa.array([part["col"].to_numpy().astype("<i4").tobytes()], pa.binary()), "m": pa.array([m.tobytes()], pa.binary())})

    met = samples.join(rows.select("sid", *[F.col(c).cast("double").alias(c) for c in columns]), "sid")
    return written(met.groupBy("sblock").applyInArrow(pack, "sblock int, cols binary, m binary"), "people")


class Fit:
    """Fits of all variants of a block; counts and slopes are those of its calls."""

    height: int
    k: int

    def counts(self) -> np.ndarray:
        raise NotImplementedError

    def slopes(self, rows: np.ndarray, w: np.ndarray, inverse: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Gradients and information of the coefficients w (the covariates', then g's) of the variants in rows, with Firth's correction if inverse is given."""
        raise NotImplementedError

    def fit(self, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(n, beta, se, method) of every variant: irls, firth where that diverges, or failed."""
        n = self.counts()
        beta, se, method = np.full(self.height, np.nan), np.full(self.height, np.nan), np.full(self.height, "failed", object)
        for name in ("irls", "firth"):
            rows = np.flatnonzero((n > 0) & (method == "failed"))
            w = np.zeros((len(rows), self.k + 1))
            for _ in range(rounds * (1 + (name == "firth"))):
                if not len(rows):
                    break
                gradient, info = self.slopes(rows, w)
                whole = np.abs(np.linalg.eigvalsh(info)).min(1) > 1e-9
                rows, w, gradient, info = rows[whole], w[whole], gradient[whole], info[whole]
                inverse = np.linalg.inv(info)
                if name == "firth":
                    gradient = self.slopes(rows, w, inverse)[0]
                step = np.clip(np.einsum("vij,vj->vi", inverse, gradient), -STEP, STEP)
                w = w + step
                done = np.abs(step).max(1, initial=0) < 1e-9
                good = done & (np.abs(w[:, -1]) < DIVERGED)
                beta[rows[good]], se[rows[good]], method[rows[good]] = w[good, -1], np.sqrt(inverse[good, -1, -1]), name
                rows, w = rows[~done], w[~done]
        return n, beta, se, method


class Batch(Fit):
    """A block's tiles with the samples' y and covariates (with the intercept first): what a step of all its variants needs."""

    def __init__(self, parts: list[tuple[bytes, bytes, bytes]], hard: bool, height: int, width: int):
        self.hard, self.height, self.k = hard, height, width - 1
        self.parts = []
        for tile, cols, m in parts:
            m = np.frombuffer(m, "<f8").reshape(-1, width)
            c = m[:, 1:]
            self.parts.append((tile, np.frombuffer(cols, "<i4"), m[:, 0], c, (c[:, :, None] * c[:, None, :]).reshape(len(c), -1)))

    def calls(self, rows: np.ndarray | slice = slice(None)) -> Iterator[tuple[np.ndarray, ...]]:
        """(g, known, y, c, products of c) of each sample block, of the variants in rows."""
        for tile, cols, y, c, cc in self.parts:
            g, known = tiles.unpack(tile, self.hard)
            yield g[rows][:, cols].astype(float), known[rows][:, cols].astype(float), y, c, cc

    def counts(self) -> np.ndarray:
        return sum((known.sum(1) for _, known, _, _, _ in self.calls()), np.zeros(self.height))

    def slopes(self, rows: np.ndarray, w: np.ndarray, inverse: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        k, m = self.k, len(rows)
        gradient, info = np.zeros((m, k + 1)), np.zeros((m, k + 1, k + 1))
        for g, known, y, c, cc in self.calls(rows):
            mu = 1 / (1 + np.exp(-np.clip(w[:, :k] @ c.T + w[:, k:] * g, -30, 30)))
            v = mu * (1 - mu) * known
            left = (y - mu) * known
            if inverse is not None:
                hat = inverse[:, :k, :k].reshape(m, k * k) @ cc.T + 2 * g * (inverse[:, :k, k] @ c.T) + inverse[:, k, k, None] * g * g
                left = left + v * hat * (0.5 - mu)
            gradient[:, :k] += left @ c
            gradient[:, k] += (left * g).sum(1)
            info[:, :k, :k] += (v @ cc).reshape(m, k, k)
            info[:, :k, k] += (v * g) @ c
            info[:, k, k] += (v * g * g).sum(1)
        info[:, k, :k] = info[:, :k, k]
        return gradient, info


class Listed(Fit):
    """A block's calls (row, g, y) with the samples' covariates c, the intercept first: an array of each."""

    def __init__(self, row: np.ndarray, g: np.ndarray, y: np.ndarray, c: np.ndarray, height: int):
        self.row, self.g, self.y, self.c, self.height, self.k = row, g, y, c, height, c.shape[1]

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.height).astype(float)

    def slopes(self, rows: np.ndarray, w: np.ndarray, inverse: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        k, m = self.k, len(rows)
        place = np.full(self.height, -1)
        place[rows] = np.arange(m)
        at = place[self.row]
        own = at >= 0
        at, y = at[own], self.y[own]
        x = np.column_stack([self.c[own], self.g[own]])
        mu = 1 / (1 + np.exp(-np.clip((w[at] * x).sum(1), -30, 30)))
        v, left = mu * (1 - mu), y - mu
        if inverse is not None:
            left = left + v * np.einsum("ei,eij,ej->e", x, inverse[at], x) * (0.5 - mu)
        add = lambda z: np.bincount(at, z, m)
        gradient, info = np.stack([add(left * x[:, i]) for i in range(k + 1)], 1), np.zeros((m, k + 1, k + 1))
        for i in range(k + 1):
            for j in range(i, k + 1):
                info[:, i, j] = info[:, j, i] = add(v * x[:, i] * x[:, j])
        return gradient, info


def logistic(t: Tiles, pheno: DataFrame, covariates: list[str], rounds: int = 30) -> DataFrame:
    """(vid, n, beta, se, method) of a 0/1 trait y on each variant and the covariates, over samples with both."""
    whole = pheno.select("sid", "y", *covariates).dropna().withColumn("__one", F.lit(1.0))
    if t.sparse:
        return _listed(t, whole, ["__one", *covariates], rounds)
    people = packed_people(t.samples, whole, ["y", "__one", *covariates])
    hard, height, width = t.hard, t.height, 2 + len(covariates)
    kind = t.variants.schema["vid"].dataType.simpleString()
    met = t.tiles.select("block", "sblock", "vids", "tile").join(people, "sblock").repartition(tiles.tasks(t.tiles), "block")

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, names = [], [None] * height
        for batch in batches:
            for r in batch.select(["vids", "tile", "cols", "m"]).to_pylist():
                parts.append((r["tile"], r["cols"], r["m"]))
                names = [a if a is not None else b for a, b in zip(names, r["vids"], strict=True)]
        n, beta, se, method = Batch(parts, hard, height, width).fit(rounds)
        at = np.flatnonzero(n > 0)
        type_ = batch.schema.field("vids").type.value_type
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in at], type_), pa.array(n[at].astype(np.int64)), pa.array(beta[at], mask=np.isnan(beta[at])), pa.array(se[at], mask=np.isnan(se[at])), pa.array(method[at].tolist())], names=["vid", "n", "beta", "se", "method"])

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return met.groupBy("block").applyInArrow(run, f"vid {kind}, n long, beta double, se double, method string")


def _listed(t: Tiles, whole: DataFrame, columns: list[str], rounds: int) -> DataFrame:
    """logistic of listed calls: each is joined to its sample's row of whole (sid, y, columns...), then goes to its block."""
    height, kind = t.height, t.variants.schema["vid"].dataType.simpleString()
    names = [f"c{i}" for i in range(len(columns))]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vids = batch.column(batch.schema.get_field_index("vids"))
            for i, r in enumerate(batch.select(["block", "sblock", "tile"]).to_pylist()):
                row, col, g = tiles.entries(r["tile"])
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(row)), pa.array(np.full(len(row), r["sblock"], np.int32)), pa.array(col.astype(np.int32)), pa.array(row.astype(np.int32)), vids[i].values.take(pa.array(row)), pa.array(g.astype(float))], names=["block", "sblock", "col", "row", "vid", "g"])

    def run(part: pa.Table) -> pa.Table:  # a block's calls
        row, g, y = (part[c].to_numpy() for c in ("row", "g", "y"))
        n, beta, se, method = Listed(row, g, y, np.column_stack([part[c].to_numpy() for c in names]), height).fit(rounds)
        at, first = np.unique(row, return_index=True)
        return pa.table({"vid": part["vid"].take(pa.array(first)), "n": pa.array(n[at].astype(np.int64)), "beta": pa.array(beta[at], mask=np.isnan(beta[at])), "se": pa.array(se[at], mask=np.isnan(se[at])), "method": pa.array(method[at].tolist())})

    calls = t.tiles.repartition(tiles.tasks(t.tiles)).mapInArrow(spread, f"block string, sblock int, col int, row int, vid {kind}, g double")
    people = t.samples.join(whole, "sid").select("sblock", "col", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names, strict=True)])
    met = calls.join(people, ["sblock", "col"]).select("block", "row", "vid", "g", "y", *names)
    return met.repartition(tiles.tasks(met), "block").groupBy("block").applyInArrow(run, f"vid {kind}, n long, beta double, se double, method string")
