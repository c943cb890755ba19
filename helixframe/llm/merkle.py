"""Operator 13: a Merkle manifest of a dataset, its trees stored in van Emde Boas order.

Every row is a leaf: the SHA-256 of its fields. The leaves of a group, in key order, are the lowest
level of a tree in which FAN neighbours have one parent. Aligned subtrees of HEIGHT levels are the
blocks of a table: a row holds the digests of its nodes in van Emde Boas order, that is, the upper
half of its levels first, then each lower half subtree, both laid out alike. An address is arithmetic
on (level, index), and serves to build, to find siblings and to read the root, which is at 0. Block
roots are the leaves of the next round of blocks, until each group has one root; the groups' roots,
in the order of the groups, are the leaves of one more such tree.

Only digests and keys are shuffled, never texts. Leaves are numbered by a range partitioning, the
counts of whose partitions are added up, so a group of any size is spread over all tasks. A proof is
made from the blocks on the way up: paths go down from round to round, one for each block.

Nulls are written as '-'; the null group comes first. Leaves with equal or null keys (null first)
are ordered by their digest, so repeated rows have defined places. An empty table has no tree. Long
texts are hashed whole. Columns that are not named as fields are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import crc_sql, keep, table

#: Children of a node, and levels between a block's root and its leaves.
FAN, HEIGHT = 8, 3
SPAN = FAN**HEIGHT
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_PATH = "array<struct<left: string, right: string>>"


def _size(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


@lru_cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Of each level, the places of its nodes in a complete tree of so many levels in van Emde Boas order."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    upper, lower = addresses(top), addresses(levels - top)
    out = list(upper)
    for depth in range(levels - top):
        index = np.arange(FAN ** (top + depth))
        subtree = index // FAN**depth
        out.append(_size(top) + subtree * _size(levels - top) + lower[depth][index % FAN**depth])
    return tuple(out)


def height_of(leaves: int) -> int:
    """Levels above so many leaves until one node is left."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // FAN), height + 1
    return height


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def fill(leaves: list[bytes], height: int) -> bytes:
    """A block's nodes in van Emde Boas order, 32 bytes each; places without a node are zero."""
    places = addresses(height + 1)
    nodes = bytearray(32 * _size(height + 1))
    level = leaves
    for depth in range(height, -1, -1):
        for place, node in zip(places[depth].tolist(), level, strict=False):
            nodes[32 * place : 32 * place + 32] = bytes.fromhex(node.decode())
        level = [digest(*level[i : i + FAN]) for i in range(0, len(level), FAN)]
    return bytes(nodes)


def siblings(nodes: bytes, height: int, leaves: int, leaf: int) -> list[tuple[bytes, bytes]]:
    """Of each level from a block's leaf up, the run's nodes left of its path and right of it, as hex text."""
    out, level, at = [], leaves, leaf
    for depth in range(height, 0, -1):
        first = at - at % FAN
        node = [nodes[32 * a : 32 * a + 32].hex().encode() for a in addresses(height + 1)[depth][first : min(first + FAN, level)].tolist()]
        out.append((b"".join(node[: at - first]), b"".join(node[at - first + 1 :])))
        level, at = -(-level // FAN), at // FAN
    return out


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of fields as hex text: of each its UTF-8 length, ':' and value, or '-' if null."""
    text = [c.cast("string") for c in fields.values()]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]).cast("binary"), 256)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with idx, the place within their grp by order, and total, the group's rows: without a window over the group."""
    at = F.monotonically_increasing_id()
    placed = keep(rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order).withColumn("at", at), "placed").withColumn("part", F.shiftright("at", 33))
    spans = placed.groupBy("grp", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))  # a group's partitions, and one row for other groups
    group = Window.partitionBy("grp")
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = keep(spans.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"), F.sum("n").over(group).alias("total")), "spans")
    return placed.join(spans, ["grp", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def blocks(leaves: DataFrame, carry: str = "") -> DataFrame:
    """One round's blocks (grp, block, total, height, nodes, ...) of leaves (grp, idx, total, node, ...); the carried column becomes a list in leaf order."""
    kind = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    more = f", {carry} array<{kind[carry]}>" if carry else ""

    def build(rows: pa.Table) -> pa.Table:  # SPAN rows at most
        rows = rows.sort_by("idx")
        total, block = rows["total"][0].as_py(), rows["block"][0].as_py()
        height = min(HEIGHT, height_of(total))
        nodes = fill([x.hex().encode() for x in rows["node"].to_pylist()], height)
        columns = {"grp": rows["grp"][:1], "block": pa.array([block], pa.int64()), "total": pa.array([total], pa.int64()), "height": pa.array([height], pa.int32()), "nodes": pa.array([nodes], pa.binary())}
        if carry:
            columns[carry] = pa.array([rows[carry].to_pylist()], pa.list_(rows.schema.field(carry).type))
        return pa.table(columns)

    rows = leaves.withColumn("block", F.expr(f"idx div {SPAN}"))
    return rows.groupBy("grp", "block").applyInArrow(build, "grp string, block long, total long, height int, nodes binary" + more)


def forest(leaves: DataFrame, carry: str = "") -> tuple[list[DataFrame], DataFrame]:
    """(the rounds of blocks, from the leaves up; (grp, node): each group's root)."""
    rounds, tops = [], []
    while True:
        made = keep(blocks(leaves, "" if rounds else carry), "blocks")
        rounds.append(made)
        roots = made.select("grp", F.col("block").alias("idx"), F.ceil(F.col("total") / SPAN).alias("total"), F.substring("nodes", 1, 32).alias("node"), (F.col("total") > SPAN).alias("more"))
        tops.append(roots.filter("not more").select("grp", "node"))
        leaves = roots.filter("more").drop("more")
        if leaves.isEmpty():
            out = tops[0]
            for top in tops[1:]:
                out = out.unionByName(top)
            return rounds, out


def paths(made: DataFrame) -> DataFrame:
    """(grp, idx, path) of each leaf of blocks with the path above them: the siblings of all levels from the leaf up."""
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                leaves = min(SPAN, r["total"] - r["block"] * SPAN)
                found = [[{"left": a.decode(), "right": b.decode()} for a, b in siblings(r["nodes"], r["height"], leaves, i)] + (r["path"] or []) for i in range(leaves)]
                yield pa.RecordBatch.from_arrays([pa.array([r["grp"]] * leaves), pa.array(range(r["block"] * SPAN, r["block"] * SPAN + leaves), pa.int64()), pa.array(found, kind)], names=["grp", "idx", "path"])

    return made.select("grp", "block", "total", "height", "nodes", "path").mapInArrow(run, f"grp string, idx long, path {_PATH}")


def with_paths(rounds: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """The lowest round's blocks with path, the siblings above them; tops (grp, path) continues the path of each group's root."""
    above = None
    for depth in range(len(rounds) - 1, -1, -1):
        made = rounds[depth]
        if tops is None:
            made = made.withColumn("path", F.lit(None).cast(_PATH))
        else:
            made = made.join(tops, "grp", "left").withColumn("path", F.when(F.col("total") <= SPAN, F.col("path")))
        if above is not None:
            made = made.join(above.select("grp", F.col("idx").alias("block"), F.col("path").alias("up")), ["grp", "block"], "left").withColumn("path", F.coalesce("up", "path")).drop("up")
        if depth:
            above = keep(paths(made), "paths")
    return made


class Manifest:
    """The stored trees of docs: rounds of blocks of every group, subroots (grp, node), rounds of the tree over them, root."""

    def __init__(self, leaves: DataFrame, carry: str = ""):
        """leaves (grp, key, node, ...): groups are ordered by UTF-8 bytes, leaves by key and node."""
        self.rounds, subroots = forest(numbered(leaves, "key", "node"), carry)
        self.subroots = keep(subroots, "subroots")
        whole = self.subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
        self.upper, top = forest(numbered(whole, "name"), "name")
        self.top = keep(top, "root")
        row = self.top.first()  # one row
        self.root = bytes(row["node"]).hex() if row else None

    def proven(self) -> DataFrame:
        """The blocks of leaves with path (the siblings above them, up to the root), subroot and root."""
        own = with_paths(self.upper)
        leaves = paths(own).join(own.select("grp", F.posexplode("name").alias("place", "name"), "block").withColumn("idx", F.col("block") * SPAN + F.col("place")).drop("block", "place"), ["grp", "idx"])
        tops = keep(leaves.select(F.col("name").alias("grp"), "path"), "tops")
        return with_paths(self.rounds, tops).join(self.subroots.select("grp", F.col("node").alias("subroot")), "grp").withColumn("root", F.lit(self.root))


def manifest(docs: DataFrame, fields: dict[str, Column], group: str, key: str, tampered: Column | None = None) -> Manifest:
    """A manifest whose leaf blocks carry (key, tampered): the leaf's key, and another digest (hex text) to hold against it, or null."""
    other = F.unhex(tampered) if tampered is not None else F.lit(None).cast("binary")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"), F.col(key).cast("long").alias("key"), F.unhex(leaf(fields)).alias("node"), other.alias("other"))
    return Manifest(rows.withColumn("row", F.struct("key", "other")), "row")


def proofs(made: Manifest) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of each leaf; the fold starts from the other digest if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                leaves, places = len(r["row"]), addresses(r["height"] + 1)[r["height"]].tolist()
                above = [(x["left"].encode(), x["right"].encode()) for x in r["path"] or []]
                columns: list[list] = [[], [], [], []]
                for i, row in enumerate(r["row"]):
                    way = siblings(r["nodes"], r["height"], leaves, i) + above
                    own = r["nodes"][32 * places[i] : 32 * places[i] + 32].hex()
                    node = (row["other"].hex() if row["other"] else own).encode()
                    for left, right in way:
                        node = digest(left, node, right)
                    for column, value in zip(columns, (row["key"], own, digest(*[x for pair in way for x in pair]).decode(), node.decode()), strict=True):
                        column.append(value)
                keys, own, proof, folded = columns
                root, subroot = r["root"], r["subroot"].hex()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(own), pa.array([subroot] * leaves), pa.array([root] * leaves), pa.array(proof), pa.array(folded), pa.array([x == root for x in folded])],
                    names=["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return made.proven().drop("grp", "block", "total").select("height", "nodes", "row", "path", "subroot", "root").mapInArrow(
        run, "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op13_merkle_veb(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(hit, leaf(fields | {"text": F.translate("text", CAPITALS, CAPITALS.lower())}))
    return proofs(manifest(docs, fields, "lang", "doc_id", changed)).withColumnRenamed("key", "doc_id")


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(text if c == "text" else c) for c in FIELDS) + ")"


def _siblings_sql(tree: str) -> str:
    run = "string_agg(node, '') OVER (PARTITION BY grp, lvl, i // 8 ORDER BY i ROWS BETWEEN "
    return f"SELECT grp, lvl, i, n, coalesce({run}UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce({run}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {tree}"


def _tree_sql(name: str, leaves: str) -> str:
    return f"{name} AS (SELECT grp, 0 AS lvl, i, n, node FROM {leaves} UNION ALL SELECT grp, lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY grp, lvl, n, i // 8)"


def _climb_sql(name: str, start: str, siblings: str) -> str:
    return f"{name} AS (SELECT * FROM {start} UNION ALL SELECT c.id, c.grp, c.lvl + 1, c.i // 8, c.proof || s.l || s.r, sha256(s.l || c.fold || s.r) FROM {name} c JOIN {siblings} s ON s.grp = c.grp AND s.lvl = c.lvl AND s.i = c.i WHERE s.n > 1)"


_CHANGED_SQL = f"CASE WHEN {crc_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')")} END"
ORACLE_SQL = f"""
WITH RECURSIVE given AS (SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf_sql("text")} AS node, {_CHANGED_SQL} AS other FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, node) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n FROM given),
{_tree_sql("tree", "leaves")},
sub AS (SELECT grp AS name, '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS i, count(*) OVER () AS n, node FROM tree WHERE n = 1),
{_tree_sql("top", "sub")},
low AS ({_siblings_sql("tree")}), high AS ({_siblings_sql("top")}),
ids AS (SELECT row_number() OVER () AS id, * FROM leaves),
{_climb_sql("inside", "(SELECT id, grp, 0 AS lvl, i, '' AS proof, coalesce(other, node) AS fold FROM ids)", "low")},
upper AS (SELECT c.id, sub.grp, 0 AS lvl, sub.i, c.proof, c.fold FROM inside c JOIN tree t ON t.grp = c.grp AND t.lvl = c.lvl AND t.i = c.i AND t.n = 1 JOIN sub ON sub.name = c.grp),
{_climb_sql("above", "upper", "high")}
SELECT doc_id, ids.node AS leaf, sub.node AS subroot, t.node AS root, sha256(a.proof) AS proof_sha256, a.fold AS folded_root, a.fold = t.node AS verified
FROM above a JOIN top t ON t.lvl = a.lvl AND t.i = a.i AND t.n = 1 JOIN ids USING (id) JOIN sub ON sub.name = ids.grp"""
