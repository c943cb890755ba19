"""Genetic tables derived from the given ones, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.operators.tiles import Tiles, tiled
from helixframe.plans.ship import ship
from helixframe.plans.stored import written

VIEWS = {
    # each supplier is a sample, each part a variant; a line item says that the pair was genotyped
    "calls": """
SELECT sid, vid, CASE WHEN (sid * 131 + vid * 577) % 53 = 0 THEN NULL WHEN u < q * q THEN 2 WHEN u < q * q + 2 * q * (100 - q) THEN 1 ELSE 0 END AS g FROM (
  SELECT sid, vid, 8 + (blk * 37) % 38 + 3 * ((blk * 7 + (hs % 5) * 13) % 5 - 2) AS q, (((hs * 7919 + hv * 104729) % 10007) * ((hs * 31 + hv * 17) % 9973)) % 10000 AS u FROM (
    SELECT sid, vid, blk, CASE WHEN sid % 50 = 0 AND (sid + vid) % 10 <> 0 THEN sid - 1 ELSE sid END AS hs, CASE WHEN (sid * 13 + vid * 7) % 10 < 8 THEN blk + 1 ELSE vid END AS hv FROM (
      SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS sid, CAST(l_partkey AS BIGINT) AS vid, CAST(l_partkey - l_partkey % 3 AS BIGINT) AS blk FROM lineitem) a) b) c""",
    "variants": "SELECT CAST(p_partkey AS BIGINT) AS vid, CAST(1 + p_partkey % 22 AS VARCHAR(2)) AS chrom, CAST(1000 + p_partkey * 97 AS BIGINT) AS pos FROM part",
    "pheno": "SELECT CAST(s_suppkey AS BIGINT) AS sid, CASE WHEN s_suppkey % 37 = 0 THEN NULL ELSE CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS DOUBLE) END AS y, CAST(s_suppkey % 5 AS BIGINT) AS pop FROM supplier",
    "variants_ref": """
SELECT CAST(c AS VARCHAR(2)) AS chrom, pos, CASE WHEN p % 5 = 0 THEN concat(CAST(c AS VARCHAR(2)), ':', CAST(pos AS VARCHAR(12)), ':', a0, ':', a1) ELSE concat('rs', CAST(p AS VARCHAR(12))) END AS id,
  a0 AS ref, a1 AS alt, CASE WHEN p % 17 = 0 OR p % 40 = 0 THEN 'PR' ELSE '.' END AS info FROM {bases} b
UNION ALL
SELECT CAST(c AS VARCHAR(2)), pos, concat('dup', CAST(p AS VARCHAR(12))), a0, a1, '.' FROM {bases} b WHERE p % 31 = 0""",
    "variants_study": """
SELECT CASE WHEN p % 2 = 1 THEN concat('chr', CAST(c AS VARCHAR(2))) ELSE CAST(c AS VARCHAR(2)) END AS chrom, pos,
  CASE WHEN p % 4 = 0 THEN concat(CAST(c AS VARCHAR(2)), ':', CAST(pos AS VARCHAR(12)), ':', ref, ':', alt) WHEN p % 29 = 0 THEN concat('rs', CAST(p + 1000000 AS VARCHAR(12))) ELSE concat('rs', CAST(p AS VARCHAR(12))) END AS id,
  ref, alt, CASE WHEN p % 7 = 0 AND p % 3 <> 0 THEN 'PR' ELSE '.' END AS info FROM (
    SELECT p, c, pos, CASE WHEN p % 7 = 0 THEN b1 ELSE a0 END AS ref, CASE WHEN p % 7 = 0 THEN a0 ELSE b1 END AS alt FROM (
      SELECT p, c, pos, CASE WHEN p % 13 = 0 THEN a2 ELSE a1 END AS b1, a0 FROM {bases} b WHERE p % 11 <> 0) t) w""",
    "samples": """
SELECT concat('F', CAST(c_custkey AS VARCHAR(12))) AS fid, concat('I', CAST(c_custkey AS VARCHAR(12))) AS iid, CAST(20 + c_custkey % 60 AS DOUBLE) AS age, CAST(1 + c_custkey % 2 AS VARCHAR(2)) AS sex,
  concat('A', CAST(c_nationkey % 5 AS VARCHAR(2))) AS ancestry, CASE WHEN c_custkey % 41 = 0 THEN 'NA' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '1' ELSE '0' END AS case_trait,
  CASE WHEN c_custkey % 37 = 0 THEN '-9' ELSE CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR(20)) END AS quant_trait FROM customer""",
    "aliases": """
SELECT CASE WHEN c_custkey % 3 = 0 THEN concat('I', CAST(c_custkey AS VARCHAR(12))) WHEN c_custkey % 3 = 1 THEN '0' ELSE concat('F', CAST(c_custkey AS VARCHAR(12))) END AS fid,
  concat('I', CAST(c_custkey AS VARCHAR(12))) AS iid FROM customer WHERE c_acctbal > 0""",
    "sumstats": """
SELECT concat('v', CAST(l_orderkey AS VARCHAR(12)), ':', CAST(l_linenumber AS VARCHAR(4))) AS id, CAST(CASE l_orderkey % 61 WHEN 0 THEN 'Y' WHEN 1 THEN 'MT' WHEN 2 THEN 'GL000192.1' WHEN 3 THEN 'PAR1' WHEN 4 THEN 'KI270302.1' WHEN 5 THEN 'XY' ELSE CASE WHEN l_partkey % 23 = 22 THEN 'X' ELSE CAST(1 + l_partkey % 23 AS VARCHAR(2)) END END AS VARCHAR(12)) AS chrom,
  CAST(1000 + l_partkey * 9700 AS BIGINT) AS pos, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS row_id, CAST(l_quantity AS BIGINT) - 3 AS mac, CASE WHEN l_orderkey % 71 <> 0 THEN CAST(900 + l_partkey % 100 AS BIGINT) END AS n,
  CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 = 0 THEN NULL WHEN (l_orderkey + l_partkey) % 1009 = 0 THEN CAST(1 + l_partkey % 97 AS DOUBLE) / 10000000000
       ELSE CAST(1 + (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 100003 AS DOUBLE) / 100003 END AS p FROM lineitem""",
    "pcs": "SELECT CAST(vec_id AS BIGINT) AS sid, CAST(label AS BIGINT) AS population, CAST(label % 5 AS BIGINT) AS super_population, CAST({x} AS DOUBLE) AS pc1, CAST({y} AS DOUBLE) AS pc2, CAST({z} AS DOUBLE) AS pc3 FROM embeddings",
}
_BASES = """(SELECT CAST(p_partkey AS BIGINT) AS p, CAST(1 + p_partkey % 22 AS BIGINT) AS c, CAST(1000 + p_partkey * 97 AS BIGINT) AS pos, substring('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS a0,
  substring('ACGT', CAST(1 + (p_partkey + 1 + p_partkey % 3) % 4 AS INT), 1) AS a1, substring('ACGT', CAST(1 + (p_partkey + 1 + (p_partkey + 1) % 3) % 4 AS INT), 1) AS a2 FROM part)"""
_TABLES = {"calls": "lineitem", "tiles": "lineitem", "sumstats": "lineitem", "samples": "customer", "aliases": "customer", "pheno": "supplier", "pcs": "embeddings"}


def view_sql(name: str, spark: bool = False) -> str:
    out = VIEWS[name].replace("{bases}", _BASES)
    for i, mark in enumerate(("{x}", "{y}", "{z}")):
        out = out.replace(mark, f"embedding[{i if spark else i + 1}]")
    return out


#: Stored once a session: their expressions would otherwise be part of every query's plan, several times over. tiles are the calls, cut.
STORED = ("calls", "sumstats", "tiles")
_held: dict[tuple, tuple[list[str], DataFrame | Tiles]] = {}


def _files(spark: SparkSession, path: str) -> tuple:
    """The files of a table with their sizes and times: another write is another table. Empty if there are none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return ()
    found = [at] if system.getFileStatus(at).isFile() else [f.getPath() for f in system.listStatus(at)]
    return tuple((f.toString(), (s := system.getFileStatus(f)).getLen(), s.getModificationTime()) for f in found)


def _folders(df: DataFrame) -> list[str]:
    return sorted({f.rpartition("/")[0] for f in df.inputFiles()})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | Tiles:
    """The derived, or else the given, table as a DataFrame over the Parquet files of sf_dir; tiles as such.

    A stored table is used again as long as the files behind it are the same and its own are there.
    """
    ship(spark)
    if name not in VIEWS and name != "tiles":
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    source = _TABLES.get(name, "part")
    path = f"{sf_dir.rstrip('/')}/{source}.parquet"
    key = ()
    if name in STORED:
        key = (spark.sparkContext.applicationId, path, name, _files(spark, path))
        if key in _held and all(_files(spark, f) for f in _held[key][0]):
            return _held[key][1]
    if name == "tiles":
        t = tiled(view(spark, sf_dir, "calls"), view(spark, sf_dir, "variants"))
        _held[key] = [f for df in (t.tiles, t.variants, t.samples) for f in _folders(df)], t
        return t
    spark.read.parquet(path).createOrReplaceTempView(f"helix_{source}")
    df = spark.sql(view_sql(name, spark=True).replace(f"FROM {source}", f"FROM helix_{source}"))
    if name in STORED:
        df = written(df, name)
        _held[key] = _folders(df), df
    return df


def with_views(sql: str, *names: str) -> str:
    """sql with the derived tables as leading CTEs, for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({view_sql(n)})" for n in names) + (", " + sql[5:] if sql[:5] == "WITH " else " " + sql)
