"""Tables behind the reports: (section, key, value) rows, manifests, log metrics and plot points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import assoc


def entity_rows(table: DataFrame, scope: str, name: str) -> DataFrame:
    """(key, value): scope:name:field for every other column of table, whose rows are told apart by the column name; NULL is empty."""
    fields = [c for c in table.columns if c != name]
    cells = F.array(*[F.struct(F.concat_ws(":", F.lit(scope), F.col(name).cast("string"), F.lit(c)).alias("key"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in fields])
    return table.select(F.explode(cells).alias("r")).select("r.*")


def count_section(status: DataFrame, min_n: int, min_cases: int, min_controls: int) -> DataFrame:
    """(section, key, value): samples, cases and controls of status (sid, case: true or false), and whether they are fewer than wanted."""
    n = status.filter("case is not null").agg(F.count(F.lit(1)).alias("samples"), F.count_if("case").alias("cases"), F.count_if(~F.col("case")).alias("controls"))
    n = n.withColumn("underpowered", (F.col("samples") < min_n) | (F.col("cases") < min_cases) | (F.col("controls") < min_controls))
    wide = n.select(*[F.col(c).cast("string").alias(c) for c in n.columns])
    return wide.unpivot([], wide.columns, "key", "value").select(F.lit("counts").alias("section"), "key", "value")


def strata_section(strata: DataFrame) -> DataFrame:
    """(section, key, value): stratum:ancestry:field of a trait's strata (ancestry, n, cases, controls, ...)."""
    return entity_rows(strata, "stratum", "ancestry").select(F.lit("strata").alias("section"), "key", "value")


def stage_report(stats: DataFrame, settings: dict[str, str], *sections: DataFrame) -> DataFrame:
    """Settings, metrics, lambda and the ten strongest signals of one association table (id, chrom, pos, row_id, p), and further sections (section, key, value)."""
    metrics = assoc.assoc_metrics(stats).select(F.lit("metrics").alias("section"), F.col("metric").alias("key"), F.format_string("%.6g", "value").alias("value"))
    inflation = assoc.genomic_lambda(stats).select(F.lit("metrics").alias("section"), F.lit("lambda").alias("key"), F.format_string("%.6f", "lambda").alias("value"))
    top = assoc.top_hits(stats).select(F.lit("top_signals").alias("section"), F.col("id").alias("key"), F.format_string("%.3e", "p").alias("value"))
    given = stats.sparkSession.createDataFrame([("settings", k, v) for k, v in settings.items()], "section string, key string, value string")
    return reduce(DataFrame.unionByName, [given, metrics, inflation, top, *sections])


def lambda_comparison(tables: dict[str, DataFrame]) -> DataFrame:
    """(label, lambda) of each of a handful of tables."""
    rows = [assoc.genomic_lambda(df).select(F.lit(label).alias("label"), "lambda") for label, df in tables.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def projection_points(ref: DataFrame, study: DataFrame, assigned: DataFrame, excluded: DataFrame) -> DataFrame:
    """(sid, pc1, pc2, sample_set, status, label): reference labels, and for the study assigned, excluded or unassigned."""
    r = ref.select("sid", "pc1", "pc2", F.lit("reference").alias("sample_set"), F.lit("reference").alias("status"), F.col("super_population").cast("string").alias("label"))
    a, x = assigned.select("sid", F.col("ancestry").cast("string").alias("a")), excluded.select("sid", F.col("reason").alias("x"))
    status = F.when(F.col("a").isNotNull(), "assigned").when(F.col("x").isNotNull(), "excluded").otherwise("unassigned")
    s = study.join(a, "sid", "left").join(x, "sid", "left").select("sid", "pc1", "pc2", F.lit("study").alias("sample_set"), status.alias("status"), F.coalesce("a", "x", F.lit("unassigned")).alias("label"))
    return r.unionByName(s)


def manifest_rows(inventory: DataFrame, scope: str, name: str | None = None) -> DataFrame:
    """(key, value): scope:path:field for the size and hash of each file; with name, a column that names the files, scope:name:field for their path as well."""
    fields = {"bytes": "size_bytes", "sha256": "sha256"} | ({"path": "path"} if name else {})
    named = inventory.select(F.col(name or "path").alias("__name"), *[F.col(c).alias(n) for n, c in fields.items()])
    return entity_rows(named, scope, "__name")


def log_metrics(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """(metric, value): group 1 of each pattern's first matching line, without thousands separators; NA if none."""
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    first = lines.agg(*[F.min_by(F.when(F.col("value").rlike(p), F.regexp_extract("value", p, 1)), F.when(F.col("value").rlike(p), F.col("line"))).alias(m) for m, p in patterns.items()])
    return first.unpivot([], list(patterns), "metric", "value").select("metric", F.coalesce(F.regexp_replace("value", ",", ""), F.lit("NA")).alias("value"))
