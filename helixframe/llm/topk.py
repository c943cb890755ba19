"""Operator 9: exact top-k inner products by the three-phase uniform threshold algorithm.

A score is a sum of partial scores over slices of the dimensions. Phase 1: every block of rows
sends, for each query, the totals of the leaders of its slices' lists; the k-th largest gathered
total is a safe cutoff. Phase 2: with the cutoffs sent to the blocks, each block collects the
entries with a partial score of at least cutoff / slices in some slice; all others lie below the
cutoff. Phase 3: the collected entries' scores are resolved exactly and ranked.

Vectors that are null, empty, or hold a null or non-finite component, and rows without an id, take
no part. Vectors are compared with those of their own length only. Repeated query rows each get
their own ranks, repeated candidate rows each count. Of equal scores the smaller id comes first. Scores
beyond the long range are clipped to it. An empty table, and one without queries, gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import keep, table

K, SCALE, EVERY = 20, 64.0, 20
BLOCK_ROWS, QUERY_ROWS, SLICES, AT_ONCE = 4096, 4096, 4, 128
#: Row blocks that meet a copy of a query block in one place, so that a query block is no single key.
BLOCKS_A_SLOT = 2
_EXACT = float(1 << 53)


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(F.col(key).isNotNull() & (F.size(vector) > 0) & fine).select(F.col(key).alias("id"), F.col(vector).alias("v"))


def row_blocks(rows: DataFrame) -> DataFrame:
    """(dim, ids, matrix): rows packed within their partition, at most BLOCK_ROWS to a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            ids, flat = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).flatten().to_numpy(zero_copy_only=False)
            begin = np.r_[0, np.cumsum(lengths)[:-1]]
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                x = np.floor(SCALE * flat[begin[at][:, None] + np.arange(dim)].astype(np.float64))
                held.setdefault(int(dim), []).append((ids[at], x))
            for dim in [d for d, parts in held.items() if sum(len(i) for i, _ in parts) >= BLOCK_ROWS]:
                yield from blocks(dim, held.pop(dim))
        for dim, parts in held.items():
            yield from blocks(dim, parts)

    def blocks(dim: int, parts: list) -> Iterator[pa.RecordBatch]:
        ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        for i in range(0, len(ids), BLOCK_ROWS):
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": [ids[i : i + BLOCK_ROWS].astype("<i8").tobytes()], "matrix": [x[i : i + BLOCK_ROWS].astype("<f8").tobytes()]})

    return rows.mapInArrow(run, "dim int, ids binary, matrix binary")


def query_blocks(queries: DataFrame) -> DataFrame:
    """(dim, qb, qids, qmatrix, cutoffs) of queries (q, id, v, qb, cutoff)."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.floor(SCALE * np.stack(frame["v"].to_numpy()).astype(np.float64))
        ids = np.column_stack([frame["q"], frame["id"]]).astype("<i8")
        return pd.DataFrame({"dim": [x.shape[1]], "qb": [frame["qb"].iloc[0]], "qids": [ids.tobytes()], "qmatrix": [x.astype("<f8").tobytes()], "cutoffs": [frame["cutoff"].to_numpy("<f8").tobytes()]})

    keyed = queries.select("q", "id", "v", "qb", F.coalesce("cutoff", F.lit(float("-inf"))).alias("cutoff"), F.size("v").alias("dim"))
    return keyed.groupBy("dim", "qb").applyInPandas(pack, "dim int, qb int, qids binary, qmatrix binary, cutoffs binary")


def _partials(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """Partial scores of each slice of the dimensions; exact."""
    if q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) >= _EXACT:
        q, x = (np.array([[int(c) for c in r] for r in m], dtype=object) for m in (q, x))
    cuts = np.array_split(np.arange(q.shape[1]), min(SLICES, q.shape[1]))
    return [q[:, c] @ x[:, c].T for c in cuts]


def _clipped(scores: np.ndarray) -> np.ndarray:
    if scores.dtype != object:
        return scores.astype(np.int64)  # whole numbers below 2**53
    return np.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in scores], np.int64)


def _each(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Unpacked pairs of a query block's part and a row block."""
    for r in range(batch.num_rows):
        dim, qids, qmatrix, cutoffs, ids, matrix = (batch.column(batch.schema.get_field_index(c))[r].as_py() for c in ("dim", "qids", "qmatrix", "cutoffs", "ids", "matrix"))
        qi, qx, cut = np.frombuffer(qids, "<i8").reshape(-1, 2), np.frombuffer(qmatrix, "<f8").reshape(-1, dim), np.frombuffer(cutoffs, "<f8")
        xi, x = np.frombuffer(ids, "<i8"), np.frombuffer(matrix, "<f8").reshape(-1, dim)
        for at in range(0, len(qi), AT_ONCE):
            s = slice(at, at + AT_ONCE)
            yield qi[s], cut[s], xi, _partials(qx[s], x)


def local_lists(pairs: DataFrame, size: int) -> DataFrame:
    """Phase 1. (q, scores): the best totals among the leaders of each slice's list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qi, _, xi, parts in _each(batch):
                lead = min(size + 1, len(xi))  # one more: the query itself may lead
                chosen = np.concatenate([np.argpartition(-p, lead - 1, axis=1)[:, :lead] for p in parts], axis=1)
                rows = np.arange(len(qi))[:, None]
                total = sum(p[rows, chosen] for p in parts)
                lists = []
                for i in range(len(qi)):
                    at, first = np.unique(chosen[i], return_index=True)
                    t = total[i, first][xi[at] != qi[i, 1]]
                    lists.append(_clipped(np.sort(t)[::-1][:size]))
                yield pa.RecordBatch.from_arrays([pa.array(qi[:, 0]), pa.array(lists, pa.list_(pa.int64()))], names=["q", "scores"])

    return pairs.mapInArrow(run, "q long, scores array<long>")


def resolved(pairs: DataFrame, k: int) -> DataFrame:
    """Phases 2 and 3. (q, query_id, vec_id, score): each block's entries that may be among the best k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qi, cut, xi, parts in _each(batch):
                cut = np.where(np.abs(cut) >= _EXACT, cut - np.abs(cut) * 2.0**-50, cut)  # huge cutoffs were rounded
                enough = np.zeros(parts[0].shape, bool)
                for p in parts:
                    enough |= p >= (cut / len(parts))[:, None]
                row, col = np.nonzero(enough & (xi[None, :] != qi[:, 1:]))
                total = _clipped(sum(p[row, col] for p in parts))
                fit = total >= cut[row]
                row, col, total = row[fit], col[fit], total[fit]
                order = np.lexsort((xi[col], ~total, row))
                row, col, total = row[order], col[order], total[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                best = place < k  # of ties the block needs no more than its k smallest ids
                row, col, total = row[best], col[best], total[best]
                yield pa.RecordBatch.from_arrays([pa.array(qi[row, 0]), pa.array(qi[row, 1]), pa.array(xi[col]), pa.array(total)], names=["q", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "q long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of every row for which is_query(key column) holds, against all other rows."""
    rows = valid(vectors, key, vector)
    data = keep(row_blocks(rows), "blocks")
    queries = keep(rows.filter(is_query(F.col("id"))), "queries")
    n_queries, n_blocks = queries.count(), data.count()
    qblocks = max(1, -(-n_queries // QUERY_ROWS))
    numbered = keep(queries.select(F.monotonically_increasing_id().alias("q"), "id", "v", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(qblocks)).cast("int").alias("qb")), "numbered")
    slots = -(-n_blocks // BLOCKS_A_SLOT) or 1
    placed = data.withColumn("slot", F.pmod(F.monotonically_increasing_id() + F.shiftright(F.monotonically_increasing_id(), 33), F.lit(slots)))
    placed = placed.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))))
    size = min(k, max(2, -(-2 * k // max(1, n_blocks))))

    def met(cutoffs: DataFrame) -> DataFrame:
        spread = query_blocks(cutoffs).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
        return placed.join(spread, ["dim", "qb", "slot"])

    gathered = local_lists(met(numbered.withColumn("cutoff", F.lit(None).cast("double"))), size).groupBy("q").agg(F.sort_array(F.flatten(F.collect_list("scores")), asc=False).alias("s"))
    cutoffs = gathered.select("q", F.get("s", F.lit(k - 1)).cast("double").alias("cutoff"))
    found = resolved(met(numbered.join(cutoffs, "q", "left")), k)
    best = found.selectExpr("*", "row_number() over (partition by q order by score desc, vec_id) as rank").filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_topk_threshold(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda c: c % EVERY == 0)


ORACLE_SQL = """
WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
