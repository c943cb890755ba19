"""Scans and sinks: text tables read as strings with explicit casts, Parquet between stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators.assoc import ranked
from helixframe.plans.stored import stored
from helixframe.sources.bed import read_bed  # noqa: F401


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a header; all text, NA kept, no quotes or comments."""
    return spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False, nullValue="\x00", emptyValue="").na.fill("")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(~F.col("value").startswith("##") & (F.trim("value") != ""))


def _fields(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(lines below the header as arrays, header names without '#'); gzip is transparent."""
    lines = _lines(spark, path)
    head = lines.first()
    if head is None:
        raise ValueError(f"{path} is empty")
    pattern = "\t" if "\t" in head[0] else r"\s+"
    names = [n.lstrip("#") for n in (head[0].split("\t") if pattern == "\t" else head[0].split())]
    body = lines.filter(F.col("value") != head[0]).select(F.split(F.trim("value"), pattern).alias("f"))
    return body, names


def read_stats_text(spark: SparkSession, path: str) -> DataFrame:
    """A statistics table with any leading '##' and blank lines; tab or white space between fields."""
    body, names = _fields(spark, path)
    return body.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_variants(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(chrom, pos, id, ref, alt, info) of a BIM or PVAR file; bad rows raise."""
    if kind == "bim":
        f = _lines(spark, path).select(F.split(F.trim("value"), r"\s+").alias("f"))
        at = {"chrom": 0, "id": 1, "pos": 3, "alt": 4, "ref": 5}
    else:
        f, names = _fields(spark, path)
        at = {n.lower(): i for i, n in enumerate(names)}
    wide = max(at[c] for c in ("chrom", "id", "pos", "ref", "alt")) + 1
    cells = f.select(F.size("f").alias("size"), *[(F.get("f", F.lit(at[c])) if c in at else F.lit(".")).alias(c) for c in ("chrom", "pos", "id", "ref", "alt", "info")])
    bad = cells.filter((F.col("size") < wide) | ~F.col("pos").rlike("^[0-9]+$") | (F.col("pos").try_cast("long") <= 0)).limit(1).collect()
    if bad:
        raise ValueError(f"{path}: bad row {bad[0]}")
    return cells.select("chrom", F.col("pos").cast("long").alias("pos"), "id", "ref", "alt", "info")


def read_samples(spark: SparkSession, path: str, missing_fid: str = "iid") -> DataFrame:
    """(fid, iid) of a list with or without a header, of one or two columns."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.split(F.trim("value"), r"\s+").alias("f"))
    first = F.upper(F.regexp_replace(F.get("f", F.lit(0)), "^#", ""))
    rows = lines.filter(~(first.isin("FID", "IID")))
    two = F.size("f") >= 2
    iid = F.when(two, F.get("f", F.lit(1))).otherwise(F.get("f", F.lit(0)))
    return rows.select(F.when(two, F.get("f", F.lit(0))).otherwise(F.lit("0") if missing_fid == "zero" else iid).alias("fid"), iid.alias("iid"))


def read_matrix(spark: SparkSession, path: str, k: int) -> DataFrame:
    """(place, values) of a space-separated numeric matrix of k columns; row i of the file has place i, from 0."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), F.trim("value").alias("value")).filter("value <> ''")
    rows = stored(lines.select("at", F.transform(F.split("value", r"\s+"), lambda x: x.try_cast("double")).alias("values")))
    if rows.filter((F.size("values") != k) | F.exists("values", lambda x: x.isNull())).limit(1).collect():
        raise ValueError(f"{path}: expected {k} numbers a row")
    # the upper bits of at are the partition: each partition's rows follow those of the partitions before it
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("m")).selectExpr("part", "coalesce(sum(m) over (order by part rows between unbounded preceding and 1 preceding), 0) as before")
    local = F.row_number().over(Window.partitionBy(part).orderBy("at")) - 1
    return rows.withColumns({"local": local, "part": part}).join(F.broadcast(sizes), "part").select((F.col("before") + F.col("local")).alias("place"), "values")


def number_samples(samples: DataFrame, order: str) -> DataFrame:
    """samples with place, from 0, by the column order: what pairs them with the rows of a matrix."""
    return ranked(samples, [order], "place").withColumn("place", F.col("place") - 1)


#: The names that association tables use for a column, in order of preference; an upper-case name is met in any case.
ALIASES = {
    "p": ["p", "P", "Pval"], "log10p": ["LOG10P", "log10p"], "chrom": ["chrom", "CHROM", "#CHROM", "Chr"], "pos": ["pos", "GENPOS", "POS", "Pos"], "id": ["variant_id", "ID", "Name"], "trait": ["trait", "Trait"],
    "ancestry": ["ancestry", "Ancestry"], "build": ["build", "Build"], "beta": ["beta_or_log_or", "BETA", "Effect"], "se": ["SE", "se"],
}
RARE_ALIASES = {
    "lci": ["LCI_Effect", "LCI_effect"], "uci": ["UCI_Effect", "UCI_effect"], "aaf": ["AAF"], "model": ["Model"], "num_cases": ["Num_Cases"], "cases_ref": ["Cases_Ref"], "cases_het": ["Cases_Het"], "cases_alt": ["Cases_Alt"],
    "num_controls": ["Num_Controls"], "controls_ref": ["Controls_Ref"], "controls_het": ["Controls_Het"], "controls_alt": ["Controls_Alt"],
}


def named_assoc(df: DataFrame, rare: bool = False) -> DataFrame:
    """An association table under its usual names, of the columns it has; LOG10P becomes p. Only those columns are read."""
    at = {}
    for name, names in (ALIASES | (RARE_ALIASES if rare else {})).items():
        if found := [n for n in names if n in df.columns]:
            at[name] = found[0]
    if "p" not in at and "log10p" not in at:
        raise ValueError("the table has neither p nor LOG10P")
    lacking = [n for n in ("chrom", "pos", "id", "trait", "beta", *(n for n in RARE_ALIASES if n != "model")) if rare and n not in at]
    if lacking:
        raise ValueError(f"a rare-variant table lacks {', '.join(lacking)}")
    p = E.finite(E.nullify(f"`{at['p']}`", MISSING_NUMBER)) if "p" in at else E.p_from_log10(E.nullify(f"`{at['log10p']}`", MISSING_NUMBER))
    text = {"chrom", "id", "trait", "ancestry", "build", "model"}
    rest = {n: E.nullify(f"`{c}`", MISSING_NUMBER) for n, c in at.items() if n not in ("p", "log10p")}
    return df.select(p.alias("p"), *[(c if n in text else c.try_cast("long") if n == "pos" else E.finite(c)).alias(n) for n, c in rest.items()])


MISSING_NUMBER = ("", "NA", "NaN", ".")


def read_assoc(spark: SparkSession, path: str, rare: bool = False) -> DataFrame:
    """named_assoc of a text table, or of Parquet."""
    return named_assoc(spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_stats_text(spark, path), rare)


def read_glm(spark: SparkSession, prefix: str) -> DataFrame:
    """The first by name of the association tables <prefix>*.glm.*, logs left out."""
    folder, _, name = prefix.rpartition("/")
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{name}*.glm.*").load(folder or ".").select("path").filter(~F.col("path").rlike(r"\.(log|id)$"))
    first = files.agg(F.min("path")).first()[0]
    if first is None:
        raise ValueError(f"no association table {prefix}*.glm.*")
    return read_stats_text(spark, first)


def count_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(n): the lines of a text table that are neither blank nor comments, less the header of each of its files."""
    per = _lines(spark, path).groupBy("_metadata.file_path").agg((F.count(F.lit(1)) - int(header)).alias("n"))  # a row per file
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))


def read_intervals(spark: SparkSession, path: str, convention: str) -> DataFrame:
    """(chrom, start, end, label): 'regions' with a header, 'bed' (0-based half-open) or 'genes' (id chrom start end) without."""
    if convention == "regions":
        t = read_stats_text(spark, path)
        rows = t.select("chrom", "start", "end", (F.col("label") if "label" in t.columns else F.lit("")).alias("label"))
    else:
        f = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"))
        order = (0, 1, 2, 3) if convention == "bed" else (1, 2, 3, 0)
        rows = f.select(*[F.get("f", F.lit(i)).alias(n) for i, n in zip(order, ("chrom", "start", "end", "label"), strict=True)])
    out = rows.select(E.strip_chr("chrom").alias("chrom"), F.col("start").try_cast("long").alias("start"), F.col("end").try_cast("long").alias("end"), "label")
    if out.filter("start is null or end is null or start > end").limit(1).collect():
        raise ValueError(f"{path}: bad interval")
    return out


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, size_bytes) of the files below root, sidecars left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter((name != ".DS_Store") & ~name.startswith("._") & ~F.contains("path", F.lit("__MACOSX"))).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


def select_panel(panels: DataFrame, role: str, build: str) -> DataFrame:
    found = panels.filter((F.lower("role") == role.lower()) & (F.upper("build") == build.upper()))
    if (n := found.limit(2).count()) != 1:
        raise ValueError(f"{n} panels for {role}, {build}")
    return found


def write_table(df: DataFrame, path: str) -> None:
    df.write.option("comment", "\x01").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="NA")  # else a header that begins with # is quoted


def write_ids(df: DataFrame, path: str) -> None:
    """A list of ids, or of several columns, without a header."""
    df.write.csv(path, sep="\t", header=False, quote="", emptyValue="", nullValue="NA")


def write_key_values(df: DataFrame, path: str) -> None:
    """(key, value) rows as tab-separated lines without a header."""
    write_ids(df.select("key", F.col("value").cast("string")), path)


def write_checked(df: DataFrame, path: str, counts: dict[str, Column], check: Callable[[dict[str, int]], str | None], *by: str) -> dict[str, int]:
    """Writes df as Parquet by columns, counting the rows that meet conditions on the way; check gives the fault that the counts show.

    One pass: the table is written beside path and takes its name if there is no fault, else it is deleted and the fault raises.
    """
    spark, seen = df.sparkSession, Observation()
    aside = f"{path.rstrip('/')}.unchecked-{uuid.uuid4().hex}"
    jvm = spark._jvm.org.apache.hadoop.fs
    system = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(jvm.Path(path)):
        raise ValueError(f"{path} is there already")
    try:
        df.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items()]).write.partitionBy(*by).parquet(aside)
        found = seen.get
        if fault := check(found):
            raise ValueError(fault)
        system.rename(jvm.Path(aside), jvm.Path(path))
    finally:
        system.delete(jvm.Path(aside), True)
    return found


def write_by_chrom(df: DataFrame, path: str) -> None:
    """Parquet by chromosome; all 22 autosomes must have rows, and no row may lack its chromosome. The rows are read once."""
    labels = [str(c) for c in range(1, 23)]

    def fault(n: dict[str, int]) -> str | None:
        empty = [c for c in labels if not n[f"chrom{c}"]]
        return f"no variants on {', '.join(empty)}" if empty else f"{n['none']} variants have no chromosome" if n["none"] else None

    chrom = F.col("chrom").cast("string")
    write_checked(df, path, {f"chrom{c}": chrom == c for c in labels} | {"none": chrom.isNull()}, fault, "chrom")


def write_sumstats(df: DataFrame, root: str) -> None:
    df.write.partitionBy("trait", "ancestry", "build").parquet(root)
