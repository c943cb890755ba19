"""Removal of variants in conflict, in the order of windows, over stretches of a chromosome that settle side by side.

Plain removal goes through the conflicts in order and drops one variant of each pair that is still
whole. Here a chromosome is cut into stretches no shorter than a window, so a removal reaches into the
next stretch at most. Every stretch is gone through on its own, as if nothing came in; then those
into which other removals come than they have counted with are gone through again, until none is left.
The first stretch is right at once and each round settles at least one more, so the result is that of
plain removal; as the effect of a removal fades within a few windows, few rounds are needed.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.tiles import Tiles, window_r2
from helixframe.plans.stored import written

#: Variants of a stretch: what a task goes through are their conflicts.
STRETCH = 8192


def settle(conflicts: DataFrame, span: int) -> DataFrame:
    """(chrom, id) that plain removal drops, of conflicts (chrom, start, k, i, j, ai, aj, gone) in the order of (k, i, j).

    i, j and gone are ids, ai and aj the places of i and j, start the place where the conflict's window
    begins; places lie less than span from the start.
    """
    rows = conflicts.select("chrom", F.expr(f"start div {span}").alias("stretch"), "k", "i", "j", F.when(F.col("gone") == F.col("i"), F.col("ai")).otherwise(F.col("aj")).alias("at"), "gone")
    rows = written(rows, "conflicts")

    def go(own: pa.Table, sent: pa.Table) -> pa.Table:  # a stretch's conflicts
        if not own.num_rows:
            return pa.table({"chrom": pa.array([], pa.string()), "stretch": pa.array([], pa.int64()), "removed": pa.array([], kind)})
        frame = own.select(["k", "i", "j", "at", "gone"]).to_pandas().sort_values(["k", "i", "j"])
        dropped = set(sent["carry"][0].as_py()) if sent.num_rows else set()
        new = []
        for i, j, at, gone in zip(*(frame[c].tolist() for c in ("i", "j", "at", "gone")), strict=True):
            if i not in dropped and j not in dropped:
                dropped.add(gone)
                new.append({"id": gone, "at": at})
        return pa.table({"chrom": own["chrom"][:1], "stretch": own["stretch"][:1], "removed": pa.array([new], kind)})

    kind = pa.list_(pa.struct([("id", pa.int64()), ("at", pa.int64())]))
    schema = "chrom string, stretch long, removed array<struct<id: bigint, at: bigint>>"

    def gone_through(own: DataFrame, sent: DataFrame) -> DataFrame:
        return own.groupBy("chrom", "stretch").cogroup(sent.groupBy("chrom", "stretch")).applyInArrow(go, schema)

    def carried(state: DataFrame) -> DataFrame:
        beyond = F.filter("removed", lambda r: r["at"] >= (F.col("stretch") + 1) * span)
        carry = F.array_sort(F.transform(beyond, lambda r: r["id"]))
        # first the list, then the next stretch: within the lambda, the alias would be taken for the column
        return written(state.select("chrom", "stretch", carry.alias("carry")).filter(F.size("carry") > 0).withColumn("stretch", F.col("stretch") + 1), "carried")

    sent = rows.sparkSession.createDataFrame([], "chrom string, stretch long, carry array<bigint>")
    state = written(gone_through(rows, sent), "removed")
    while True:
        now = carried(state)
        both = now.withColumnRenamed("carry", "new").join(sent, ["chrom", "stretch"], "full_outer")
        changed = written(both.filter(~F.col("new").eqNullSafe(F.col("carry"))).select("chrom", "stretch"), "changed")
        if changed.isEmpty():
            return state.select("chrom", F.inline("removed")).select("chrom", "id")
        again = gone_through(rows.join(changed, ["chrom", "stretch"], "left_semi"), now)
        state, sent = written(state.join(changed, ["chrom", "stretch"], "left_anti").unionByName(again), "removed"), now


def prune_windows(t: Tiles, frequencies: DataFrame, window: int = 1500, step: int = 150, r2: float = 0.1, minimum: int = 0, stretch: int = STRETCH) -> DataFrame:
    """(vid) left after pruning by windows of so many variants of a chromosome, each begun step variants after the last.

    Within a window, pairs in order, of each whose r2 is above the limit the rarer by frequencies
    (vid, maf) goes, ties the later. Fewer variants left than minimum are an error.
    """
    if not 0 < step <= window:
        raise ValueError("steps go from 1 to the window's width")
    maf = frequencies.select("vid", "maf")
    found = window_r2(t, window, step, r2)
    sided = found.join(maf.withColumnsRenamed({"vid": "a", "maf": "ma"}), "a").join(maf.withColumnsRenamed({"vid": "b", "maf": "mb"}), "b")
    gone = F.when(F.col("ma") < F.col("mb"), F.col("i")).otherwise(F.col("j"))
    conflicts = sided.select("chrom", (F.col("k") * step).alias("start"), "k", "i", "j", F.col("i").alias("ai"), F.col("j").alias("aj"), gone.alias("gone"))
    span = -(-max(stretch, window) // step) * step
    removed = settle(conflicts, span)
    left = t.variants.join(removed.withColumnRenamed("id", "idx"), ["chrom", "idx"], "left_anti").select("vid")
    if minimum and (n := left.count()) < minimum:
        raise ValueError(f"{n} variants are left after pruning; at least {minimum} are needed")
    return left

