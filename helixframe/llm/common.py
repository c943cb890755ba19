"""Helpers shared by the corpus operators: table access, shared-folder tables, batching of texts."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.plans.ship import ship

#: Bytes of text that one step of a Python task holds unpacked at a time.
CHUNK_BYTES = 4 << 20
#: Rows in an Arrow batch, unless the session says otherwise: whole texts travel in them, twice the batch in memory.
BATCH_ROWS = 2_000


def ready(spark: SparkSession) -> SparkSession:
    """Ships the package to the executors and bounds the batches that carry texts."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. In local mode, where they are one process, a temporary one will do."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


_kept: list[str] = []


def keep(df: DataFrame, name: str, hold: bool = False) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage is cut and survives lost executors.

    scratch() deletes such tables, but for those to hold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not hold:
        _kept.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that keep() wrote within; what was made of them must have been written elsewhere by then."""
    begin = len(_kept)
    yield
    for path in _kept[begin:]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _kept[begin:]


def draw_labelled(docs: DataFrame, labels: DataFrame, key: str, by: str, per_class: int) -> DataFrame | None:
    """A stored table of labels rows (key, ..., draw): at most per_class of each value 0 and 1 of by, drawn by a hash of the key.

    Only keys meet, never texts. A label that repeats counts once; None unless both values occur.
    """
    draw = F.shiftrightunsigned(F.xxhash64(key), 2)
    known = labels.filter(F.col(by).isin(0, 1) & F.col(key).isNotNull()).distinct().join(docs.select(key), key, "left_semi")
    known = keep(known.withColumn("draw", draw), "labelled")
    counts = {int(r[0]): r[1] for r in known.groupBy(by).count().collect()}
    if set(counts) != {0, 1}:
        return None
    order = ["draw", key, *[c for c in labels.columns if c not in (key, by)]]
    best = [known.filter((F.col(by) == c) & (F.col("draw") <= int(min(1.0, 4 * per_class / n) * (1 << 62)))).orderBy(*order).limit(per_class) for c, n in counts.items()]
    return keep(best[0].unionByName(best[1]), "drawn")


def identified(docs: DataFrame, stored: bool) -> DataFrame:
    """(file, at, docs: struct of all columns): each stored row by its file and its place in it, whatever keys it shares.

    The reader gives both, so they are the same in every pass over a stored table, also when tasks are run
    again. A DataFrame that isn't a plain scan of files is stored first.
    """
    if not stored:
        docs = keep(docs, "rows")
    place = docs.metadataColumn("_metadata")
    return docs.select(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("at"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("docs"))


def crc_mod(column: str, mod: int):
    """crc32 of the id written as text, modulo mod: the fold of a row."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(mod))


def crc_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text: bit by bit, each byte on the first of its eight steps."""
    raw = f"hex(encode({text}))"
    steps = f"list_transform(range(4 * length({raw})), lambda i: CASE WHEN i % 8 = 0 THEN CAST('0x' || substr({raw}, CAST(i // 4 + 1 AS BIGINT), 2) AS BIGINT) ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"


def crc_mod_py(value: int, mod: int) -> int:
    return zlib.crc32(str(value).encode()) % mod


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of about limit bytes; null counts as empty."""
    column_at = batch.schema.get_field_index(column)
    texts = batch.column(column_at)
    begin, held, out = 0, 0, []
    for i in range(batch.num_rows):
        t = texts[i].as_py() or ""
        out.append(t)
        held += len(t)
        if held >= limit:
            yield begin, out
            begin, held, out = i + 1, 0, []
    if out:
        yield begin, out
