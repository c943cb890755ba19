"""Checks. A check returns the offending rows; raising is left to require()."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators.tiles import tasks


def require(problems: DataFrame, message: str, show: int = 5) -> None:
    """Raises ValueError naming the first offending rows, if there are any."""
    if rows := problems.limit(show).collect():
        raise ValueError(f"{message}: " + "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows))


def expect_columns(df: DataFrame, *names: str) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def same_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of only one side, with the side; empty if the sets are equal.

    Rows are dealt to all tasks before they are grouped: the task that reads a file would otherwise hold its distinct rows.
    """
    names = [f"`{c}`" for c in a.columns]
    both = a.select("*", F.lit(1).alias("side")).union(b.select("*", F.lit(2).alias("side")))
    per = both.repartition(tasks(a), *names).groupBy(*names).agg(F.bit_or("side").alias("side"))
    return per.filter("side < 3").withColumn("side", F.when(F.col("side") == 1, "left").otherwise("right"))


def not_functional(df: DataFrame, a: str, b: str) -> DataFrame:
    """Values of a that map to several values of b."""
    return df.groupBy(a).agg(F.countDistinct(b).alias("n")).filter("n > 1")


#: Intervals are looked over in stretches of so many bases; each stretch also knows the furthest end of those before it.
STRETCH = 1 << 22


def check_intervals(iv: DataFrame, build: str | None = None) -> DataFrame:
    """Intervals that are reversed, overlap an earlier one of their chromosome, or name another build.

    A window holds one stretch of a chromosome; the ends of earlier stretches come from one row a stretch.
    """
    placed = iv.withColumn("__s", F.floor(F.col("start") / STRETCH))
    ends = placed.groupBy("chrom", "__s").agg(F.max("end").alias("m"))
    ends = ends.selectExpr("chrom", "__s", "max(m) over (partition by chrom order by __s rows between unbounded preceding and 1 preceding) as __e")
    before = F.greatest(F.expr("max(end) over (partition by chrom, __s order by start, end rows between unbounded preceding and 1 preceding)"), F.col("__e"))
    rule = F.when(F.col("start") > F.col("end"), "reversed").when(F.col("start") <= F.col("before"), "overlap")
    if build is not None and "build" in iv.columns:
        rule = rule.when(F.col("build") != build, "build")
    return placed.join(ends, ["chrom", "__s"]).withColumn("before", before).withColumn("rule", rule).filter("rule is not null").select(*iv.columns, "rule")


def check_inventory(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, problem) of files that are extra, missing, or differ in size or hash, and of declared paths that are absolute, climb, or repeat."""
    d = declared.select("path", F.col("sha256").alias("dh"), F.col("size_bytes").alias("ds"))
    a = actual.select("path", F.col("sha256").alias("ah"), F.col("size_bytes").alias("asz"))
    problem = F.when(F.col("ah").isNull(), "missing").when(F.col("dh").isNull(), "extra").when(F.col("ds") != F.col("asz"), "size").when(F.col("dh") != F.col("ah"), "hash")
    found = d.dropDuplicates(["path"]).join(a, "path", "full_outer").select("path", problem.alias("problem")).filter("problem is not null")
    bad = declared.filter(F.col("path").rlike(r"^/|(^|/)\.\.(/|$)|^$")).select("path", F.lit("path").alias("problem"))
    return found.unionByName(bad).unionByName(duplicates(declared, "path").select("path", F.lit("duplicate").alias("problem")))


def check_cpra(v: DataFrame) -> DataFrame:
    """(id, problem): ids that aren't chrom:pos:ref:alt of an autosomal ACGT variant with a known reference, or repeat."""
    known = F.coalesce(E.strip_chr("chrom").try_cast("int").between(1, 22), F.lit(False))
    problem = (
        F.when(~known, "not_autosomal").when(~(F.col("ref").rlike("^[ACGT]+$") & F.col("alt").rlike("^[ACGT]+$")), "alleles")
        .when(F.col("id") != E.cpra(E.strip_chr("chrom"), "pos", "ref", "alt"), "id").when(E.info_flag("info", "PR"), "provisional")
    )
    found = v.select("id", problem.alias("problem")).filter("problem is not null")
    return found.unionByName(duplicates(v, "id").select("id", F.lit("duplicate").alias("problem")))


def rules(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(rule, violations): how many rows break each rule; one pass."""
    wide = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return wide.unpivot([], list(checks), "rule", "violations")


def check_domains(samples: DataFrame, sexes: tuple[str, ...] = ("0", "1", "2"), numeric: tuple[str, ...] = ()) -> DataFrame:
    """(column, violations): sex codes outside sexes, and values of numeric columns that are there but no numbers."""
    missing = ("", "NA", "-9", ".")
    return rules(samples, {"sex": F.col("sex").isin(*sexes)} | {c: E.finite(c).isNotNull() | F.col(c).isNull() | F.col(c).cast("string").isin(*missing) for c in numeric}).withColumnRenamed("rule", "column")


def check_traits(traits: DataFrame) -> DataFrame:
    """(trait, problem) of a registry (trait, case, control): blank, spaced or odd names, repeats, half-set or equal codes."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    problem = (
        F.when(blank("trait"), "blank").when(F.col("trait") != F.trim("trait"), "space").when(~F.col("trait").rlike("^[A-Za-z0-9][A-Za-z0-9._-]*$"), "name")
        .when(blank("case") != blank("control"), "half_set").when(~blank("case") & (F.col("case") == F.col("control")), "equal_codes")
    )
    return traits.select("trait", problem.alias("problem")).filter("problem is not null").unionByName(duplicates(traits, "trait").select("trait", F.lit("repeated").alias("problem")))


def odd_trait_values(samples: DataFrame, trait: str, case: str, control: str, missing: tuple[str, ...] = ("", "NA", "-9", ".")) -> DataFrame:
    """(value, n): values of a binary trait outside its codes and the missing ones."""
    return samples.filter(F.col(trait).isNotNull() & ~F.col(trait).isin(case, control, *missing)).groupBy(F.col(trait).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def check_ids(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value, n): identifiers that are an array turned into text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).filter(F.col("value").startswith("[")).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def check_artifacts(inventory: DataFrame, banned: list[str]) -> DataFrame:
    """(path, pattern) of files whose name matches one of the banned patterns."""
    return inventory.select("path", F.inline(F.array(*[F.struct(F.lit(p).alias("pattern"), F.col("path").rlike(p).alias("hit")) for p in banned]))).filter("hit").select("path", "pattern")


def check_htp(htp: DataFrame, variants: DataFrame, ld_ids: DataFrame, trait: str, cases: int, controls: int) -> DataFrame:
    """(rule, violations) of HTP rows against the target variants (id), the LD index (id), the trait, and the model's counts."""
    groups = {"cases": ("cases_ref", "cases_het", "cases_alt"), "controls": ("controls_ref", "controls_het", "controls_alt")}
    counts = ["num_cases", "num_controls", *groups["cases"], *groups["controls"]]
    whole = reduce(lambda a, b: a & b, [(F.col(c) >= 0) & (F.col(c) == F.floor(F.col(c))) for c in counts])
    totals = reduce(lambda a, b: a & b, [F.col(f"num_{k}") == reduce(lambda a, b: a + b, map(F.col, parts)) for k, parts in groups.items()])
    own = rules(htp, {
        "name": F.col("name") == E.cpra(E.strip_chr("chr"), "pos", F.upper("ref"), F.upper("alt")), "score": F.col("info").rlike("(^|;)SCORE="), "counts": whole, "totals": totals,
        "model": (F.col("num_cases") <= cases) & (F.col("num_controls") <= controls), "trait": F.col("trait") == trait,
    })
    lacking = [htp.join(ids.select(F.col("id").alias("name")), "name", "left_anti").agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("violations")) for rule, ids in (("not_in_target", variants), ("not_in_ld", ld_ids))]
    return own.unionByName(lacking[0].select("rule", "violations")).unionByName(lacking[1].select("rule", "violations"))


def check_status(status: DataFrame, keeps: DataFrame, expected: DataFrame) -> DataFrame:
    """(group_id, problem): group status rows that contradict themselves, their keep lists (group_id, sid), or the expected groups (group_id, trait)."""
    kept = keeps.groupBy("group_id").agg(F.count(F.lit(1)).alias("kept"))
    k, active = F.coalesce("kept", F.lit(0)), ~F.col("skipped")
    tests = {
        "reason": F.col("skipped") != (F.coalesce("reason", F.lit("")) != ""), "skipped_with_samples": F.col("skipped") & (k > 0), "active_without_samples": active & (k < 1), "model_n": F.col("model_n") != k,
        "usable_n": active & (F.col("usable_n") != k), "cases": active & (F.col("kind") == "bt") & (F.col("cases") + F.col("controls") != k),
    }
    met = status.join(kept, "group_id", "left").select("group_id", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))).alias("problem"))
    repeats = duplicates(status, "group_id").select("group_id", F.lit("repeated").alias("problem"))
    pairs = status.select("group_id", "trait", F.lit(1).alias("s")).join(expected.select("group_id", "trait", F.lit(1).alias("e")), ["group_id", "trait"], "full_outer")
    cover = pairs.select("group_id", F.when(F.col("s").isNull(), "missing").when(F.col("e").isNull(), "unexpected").alias("problem")).filter("problem is not null")
    return met.unionByName(repeats).unionByName(cover)


def overlap_gate(variants: DataFrame, min_n: int = 10_000, warn_n: int = 50_000) -> DataFrame:
    """(n, status): fail below min_n shared variants, warn below warn_n, else pass."""
    n = F.col("n")
    return variants.agg(F.count(F.lit(1)).alias("n")).withColumn("status", F.when(n < min_n, "fail").when(n < warn_n, "warn").otherwise("pass"))


def check_roles(df: DataFrame, roles: list[str]) -> DataFrame:
    """(role, problem) of a table (role, release): roles that are absent or repeat, and blank releases."""
    wanted = df.sparkSession.createDataFrame([(r,) for r in roles], "role string")
    per = df.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.trim(F.coalesce("release", F.lit(""))) == "").alias("blank"))
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").when(F.col("blank") > 0, "no_release")
    return wanted.join(per, "role", "left").select("role", problem.alias("problem")).filter("problem is not null")


def same_samples(**sets: DataFrame) -> DataFrame:
    """(fid, iid, in_<name>...): samples that some of the named sets lack."""
    tagged = reduce(DataFrame.unionByName, [d.select("fid", "iid", F.lit(n).alias("set")) for n, d in sets.items()])
    per = tagged.groupBy("fid", "iid").agg(*[F.bool_or(F.col("set") == n).alias(f"in_{n}") for n in sets])
    return per.filter(~reduce(lambda a, b: a & b, [F.col(f"in_{n}") for n in sets]))


def same_variants(a: DataFrame, b: DataFrame) -> DataFrame:
    """same_set of the signatures (id, chrom, pos, smaller allele, larger allele)."""
    sign = lambda v: v.select("id", "chrom", "pos", F.least("ref", "alt").alias("lo"), F.greatest("ref", "alt").alias("hi"))
    return same_set(sign(a), sign(b))


def check_panel(panel: DataFrame, original: DataFrame, removed: DataFrame, labels: dict[str, int]) -> DataFrame:
    """(rule, violations) of a repaired panel (id, chrom, pos, label): label sizes, unique ids and loci, and original less removed being the panel."""
    given = panel.sparkSession.createDataFrame(list(labels.items()), "label string, expected long")
    sizes = panel.groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(given, "label", "full_outer").agg(F.count_if(~F.col("n").eqNullSafe(F.col("expected"))).alias("violations"))
    parts = {
        "label_sizes": sizes, "unique_ids": duplicates(panel, "id").agg(F.count(F.lit(1)).alias("violations")), "unique_loci": duplicates(panel, "chrom", "pos").agg(F.count(F.lit(1)).alias("violations")),
        "removal": same_set(original.select("id").join(removed.select("id"), "id", "left_anti"), panel.select("id")).agg(F.count(F.lit(1)).alias("violations")),
    }
    return reduce(DataFrame.unionByName, [d.select(F.lit(n).alias("rule"), "violations") for n, d in parts.items()])
