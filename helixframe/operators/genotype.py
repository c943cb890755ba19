"""Genotype statistics over calls (sid, vid, g): g is 0, 1, 2, a dosage, or NULL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import expr as E
from helixframe.operators import pruning, quality, tiles
from helixframe.operators.tiles import Tiles
from helixframe.plans.stored import written

KING_CUTOFF = 0.0884


def allele_counts(calls: DataFrame) -> DataFrame:
    """Genotype counts, allele frequency and call rate per variant; one shuffle with map-side counts."""
    n, alt = F.count("g"), F.coalesce(F.sum("g"), F.lit(0))
    counted = calls.groupBy("vid").agg(
        F.count_if(F.col("g") == 0).alias("hom_ref"), F.count_if(F.col("g") == 1).alias("het"), F.count_if(F.col("g") == 2).alias("hom_alt"),
        F.count_if(F.col("g").isNull()).alias("missing"), n.alias("n"), alt.alias("alt_count"), F.sum(F.col("g") * F.col("g")).alias("sum_sq"),
    )
    freq = F.col("alt_count") / (2 * F.col("n"))
    return counted.withColumns({
        "alt_freq": F.when(F.col("n") > 0, freq), "maf": F.when(F.col("n") > 0, F.least(freq, 1 - freq)),
        "mac": F.least(F.col("alt_count"), 2 * F.col("n") - F.col("alt_count")), "call_rate": F.col("n") / (F.col("n") + F.col("missing")),
    })


def mach_r2(counts: DataFrame) -> DataFrame:
    """counts with r2, the dosage variance over its expectation; NULL where the frequency is 0 or 1."""
    p = F.col("alt_freq")
    variance = F.col("sum_sq") / F.col("n") - F.pow(F.col("alt_count") / F.col("n"), 2)
    return counts.withColumn("r2", F.when((p > 0) & (p < 1), variance / (2 * p * (1 - p))))


def variant_qc(calls: DataFrame, maf: float = 0.01, max_missing: float = 0.05, mac: int = 0, v: DataFrame | None = None, snps_only: bool = False, chroms: list[str] | None = None, max_alleles: int | None = None) -> DataFrame:
    """calls of the variants that pass: by their counts, and with v (vid, chrom, ref, alt) by kind, chromosome and number of alleles."""
    kept = allele_counts(calls).filter((F.col("maf") >= maf) & (F.col("missing") / (F.col("n") + F.col("missing")) <= max_missing) & (F.col("mac") >= mac))
    if v is not None:
        if snps_only:
            v = v.filter(F.col("ref").rlike("^[ACGT]$") & F.col("alt").rlike("^[ACGT](,[ACGT])*$"))
        if chroms is not None:
            v = v.filter(E.strip_chr("chrom").isin(*chroms))
        if max_alleles is not None:
            v = v.filter(F.size(F.split("alt", ",")) + 1 <= max_alleles)
        kept = kept.join(v.select("vid"), "vid", "left_semi")
    return calls.join(kept.select("vid"), "vid", "left_semi")


def sample_missing(calls: DataFrame) -> DataFrame:
    return calls.groupBy("sid").agg((F.count_if(F.col("g").isNull()) / F.count(F.lit(1))).alias("missing_rate"))


def sample_qc(calls: DataFrame, max_missing: float = 0.05) -> DataFrame:
    return calls.join(sample_missing(calls).filter(F.col("missing_rate") <= max_missing).select("sid"), "sid", "left_semi")


def hardcall_qc(ids: DataFrame, counts: DataFrame, mac_min: int = 100) -> DataFrame:
    """(id, mac, variance, status): pass, or why a variant fails. Negative or absent counts, and ids that repeat, are errors (see bad_counts)."""
    quality.require(bad_counts(counts), "genotype counts")
    ref, alt, n = 2 * F.col("hom_ref") + F.col("het"), F.col("het") + 2 * F.col("hom_alt"), F.col("hom_ref") + F.col("het") + F.col("hom_alt")
    mean = alt / n
    variance = F.greatest((F.col("het") + 4 * F.col("hom_alt")) / n - mean * mean, F.lit(0.0))
    judged = ids.join(counts.select("id", "hom_ref", "het", "hom_alt"), "id", "left").withColumns({"mac": F.least(ref, alt), "variance": F.when(n > 0, variance)})
    status = F.when(F.col("hom_ref").isNull(), "missing_from_plink2_gcount").when(F.coalesce("variance", F.lit(0.0)) <= 1e-12, "zero_hardcall_variance").when(F.col("mac") < mac_min, "hardcall_mac_below_min").otherwise("pass")
    return judged.select("id", "mac", "variance", status.alias("status"))


def bad_counts(counts: DataFrame) -> DataFrame:
    """(id, problem): rows of genotype counts that are negative, absent or not whole, and ids that repeat."""
    whole = [F.coalesce((F.col(c) >= 0) & (F.col(c) == F.floor(F.col(c))), F.lit(False)) for c in ("hom_ref", "het", "hom_alt")]
    odd = counts.filter(~(whole[0] & whole[1] & whole[2])).select("id", F.lit("count").alias("problem"))
    return odd.unionByName(quality.duplicates(counts, "id").select("id", F.lit("repeated").alias("problem")))


def hwe_samples(pheno: DataFrame, keep: DataFrame, binary: bool) -> DataFrame:
    """(sid): the kept samples on which Hardy-Weinberg proportions are tested: controls (y 0), or all with a quantitative value."""
    return pheno.filter("y = 0" if binary else "y is not null").join(keep.select("sid"), "sid", "left_semi").select("sid")


def hwe_exact(counts: DataFrame) -> DataFrame:
    """counts with p_hwe, the exact Hardy-Weinberg probability (sum over no likelier heterozygote counts)."""

    def p_value(hom1: int, het: int, hom2: int) -> float:
        rare, n = 2 * min(hom1, hom2) + het, hom1 + het + hom2
        if not n:
            return 1.0
        h = np.arange(rare % 2, rare + 1, 2)
        minor, major = (rare - h) / 2, n - h - (rare - h) / 2
        # log odds of h + 2 against h heterozygotes
        step = np.log(4 * minor[:-1] * major[:-1]) - np.log((h[:-1] + 2) * (h[:-1] + 1))
        log = np.r_[0, np.cumsum(step)]
        p = np.exp(log - log.max())
        at = p[(het - rare % 2) // 2]
        return float(min(1.0, p[p <= at * (1 + 1e-9)].sum() / p.sum()))

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        # equal counts have equal probabilities: each triple once
        triples, at = np.unique(np.column_stack([a, b, c]).astype(np.int64).reshape(-1, 3), axis=0, return_inverse=True)
        return pd.Series(np.array([p_value(*map(int, t)) for t in triples])[at.ravel()] if len(triples) else np.zeros(0))

    return counts.withColumn("p_hwe", exact("hom_ref", "het", "hom_alt"))


def near_pairs(variants: DataFrame, window: int) -> DataFrame:
    """(a, b) of variants (vid, chrom, pos) at most window apart on a chromosome, a before b; met through bins."""
    left = variants.select("chrom", F.col("vid").alias("a"), F.col("pos").alias("pa"), F.floor(F.col("pos") / window).alias("bin"))
    right = variants.select("chrom", F.col("vid").alias("b"), F.col("pos").alias("pb"), F.floor(F.col("pos") / window).alias("home"))
    right = right.withColumn("bin", F.explode(F.array(F.col("home"), F.col("home") - 1)))
    near = (F.col("pb") - F.col("pa")).between(0, window) & ((F.col("pa") < F.col("pb")) | (F.col("a") < F.col("b")))
    return left.join(right, ["chrom", "bin"]).filter(near & (F.col("a") != F.col("b"))).select("a", "b")


def pair_r2(calls: DataFrame | Tiles, pairs: DataFrame) -> DataFrame:
    """pairs (a, b) with n, r and r2 over samples called at both variants, by products of tiles; calls are cut into tiles first."""
    return tiles.pair_r2(calls if isinstance(calls, Tiles) else tiles.tiled(calls), pairs)


def ld_prune(calls: DataFrame | Tiles, variants: DataFrame, window: int, r2: float, frequencies: DataFrame | None = None, stretch: int = 0) -> DataFrame:
    """(vid) left after pruning by distance: in position order, of each conflicting pair the rarer goes, ties the later.

    frequencies (vid, maf) are those of calls unless given, as they must be with tiles. Stretches of
    positions, no shorter than the window, settle side by side. prune_windows counts variants instead.
    """
    maf = (frequencies if frequencies is not None else allele_counts(calls)).select("vid", "maf")
    t = calls if isinstance(calls, Tiles) else tiles.tiled(calls, variants)
    side = t.variants.select("vid", "chrom", "pos", "idx").join(maf, "vid")
    rows = pair_r2(t, near_pairs(variants, window)).filter(F.col("r2") > r2).select("a", "b")
    rows = rows.join(side.withColumnsRenamed({"vid": "a", "pos": "ai", "maf": "ma", "idx": "i"}), "a").join(side.drop("chrom").withColumnsRenamed({"vid": "b", "pos": "aj", "maf": "mb", "idx": "j"}), "b")
    gone = F.when(F.col("ma") < F.col("mb"), F.col("i")).otherwise(F.col("j"))
    conflicts = rows.select("chrom", F.col("ai").alias("start"), F.col("ai").alias("k"), "i", "j", "ai", "aj", gone.alias("gone"))
    removed = pruning.settle(conflicts, max(stretch, window + 1)).withColumnRenamed("id", "idx")
    return t.variants.join(removed, ["chrom", "idx"], "left_anti").select("vid")


def kinship_pairs(calls: DataFrame | Tiles, above: float | None = None) -> DataFrame:
    """KING-robust (a, b, hethet, ibs0, het_a, het_b, phi) of sample pairs, over variants called in both, by products of tiles; with above, those of a larger phi."""
    return tiles.kinship(calls if isinstance(calls, Tiles) else tiles.tiled(calls), above).drop("n")


def unrelated(calls: DataFrame, cutoff: float = KING_CUTOFF, tiled: Tiles | None = None) -> DataFrame:
    """(sid) after removing the most connected sample of the related pairs again and again (ties: the larger id).

    Removals in different families don't touch one another, so each connected family is thinned on its own:
    a removal takes one look at the family's degrees and one at the sample's links. tiled: the tiles of calls.
    """
    related = written(kinship_pairs(tiled or calls, cutoff).select("a", "b"), "related")
    family = families(related)

    def thin(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # a family's links, each both ways
        parts = [np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("a", "b")]) for batch in batches]
        ids = np.unique(np.concatenate([np.unique(p) for p in parts]))
        parts = [np.searchsorted(ids, p).astype(np.int32) for p in parts]
        both = np.concatenate([p[i].astype(np.int64) << 32 | p[1 - i] for p in parts for i in (0, 1)])
        both.sort()
        degree, to = np.zeros(len(ids), np.int64), both.astype(np.int32)  # the lower half
        for begin in range(0, len(both), 1 << 20):
            degree += np.bincount(both[begin : begin + (1 << 20)] >> 32, minlength=len(ids))
        del parts, both
        first = np.r_[0, np.cumsum(degree)]
        gone = []
        while True:
            worst = len(ids) - 1 - int(np.argmax(degree[::-1]))  # ids ascend
            if degree[worst] <= 0:
                break
            degree[to[first[worst] : first[worst + 1]]] -= 1
            degree[worst] = -len(ids)  # below zero whatever goes later
            gone.append(ids[worst])
        yield pa.RecordBatch.from_arrays([pa.array(np.array(gone, np.int64))], names=["sid"])

    thin.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    gone = related.join(family.select(F.col("sid").alias("a"), "family"), "a").select("a", "b", "family").groupBy("family").applyInArrow(thin, "sid long")
    return calls.select("sid").distinct().join(gone, "sid", "left_anti")


def _forest(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect what links connect: of each batch, every sample with the smallest id it reaches there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, label = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of the partition's batches so far: samples, and their roots' places
        for batch in batches:
            pairs = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("a", "b")]).astype(np.int64)
            known = np.unique(np.concatenate([ids, pairs.ravel()]))
            a, b = np.searchsorted(known, np.concatenate([np.stack([ids, ids[label]]), pairs], 1) if len(ids) else pairs)
            root = np.arange(len(known))
            while len(a):
                low, high = np.minimum(a, b), np.maximum(a, b)
                np.minimum.at(root, high, low)
                while (root[root] != root).any():
                    root = root[root]
                a, b = root[a], root[b]
                apart = a != b
                a, b = a[apart], b[apart]
            ids, label = known, root
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def families(related: DataFrame) -> DataFrame:
    """(sid, family): the smallest id that links (a, b) connect a sample with; labels spread until none changes.

    A task's links are cut down to one a sample first, so that what spreads grows with the samples.
    """
    whole = all(related.schema[c].dataType.typeName() == "long" for c in ("a", "b"))
    related = written(_forest(related) if whole else related.select("a", "b"), "links")
    both = written(related.unionByName(related.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both")
    label = written(both.select(F.col("a").alias("sid")).distinct().withColumn("family", F.col("sid")), "family")
    while True:
        heard = both.join(label.withColumnsRenamed({"sid": "b"}), "b").groupBy(F.col("a").alias("sid")).agg(F.min("family").alias("other"))
        # a label's own label is taken over as well, which halves the way to go
        jump = label.select(F.col("sid").alias("family"), F.col("family").alias("beyond"))
        new = label.join(heard, "sid").select("sid", F.least("family", "other").alias("family")).join(jump, "family", "left")
        new = written(new.select("sid", F.least("family", F.coalesce("beyond", "family")).alias("family")), "family")
        if new.join(label, ["sid", "family"], "left_anti").isEmpty():
            return new
        label = new


def project_pcs(calls: DataFrame, weights: DataFrame, freqs: DataFrame) -> DataFrame:
    """(sid, pc, score): standardised genotypes by the weights (vid, pc, w) of a fit with frequencies (vid, p)."""
    p = F.col("p")
    z = (F.col("g") - 2 * p) / F.sqrt(2 * p * (1 - p))
    met = calls.filter("g is not null").join(freqs.filter("p > 0 and p < 1"), "vid").join(weights, "vid")
    return met.groupBy("sid", "pc").agg((F.sum(z * F.col("w")) / (2 * F.count(F.lit(1)))).alias("score"))


def inbreeding(calls: DataFrame) -> DataFrame:
    """(sid, n, observed, expected, f): one minus observed over expected heterozygotes."""
    counts = allele_counts(calls).filter("n > 1 and alt_freq > 0 and alt_freq < 1")
    expected = 2 * F.col("alt_freq") * (1 - F.col("alt_freq")) * 2 * F.col("n") / (2 * F.col("n") - 1)
    met = calls.filter("g is not null").join(counts.select("vid", expected.alias("e")), "vid")
    per = met.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("g") == 1).alias("observed"), F.sum("e").alias("expected"))
    return per.withColumn("f", F.when(F.col("expected") > 0, 1 - F.col("observed") / F.col("expected")))


#: Genes meet variants through stretches of so many bases.
GENE_BIN = 1 << 16


def in_genes(variants: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene, vid) of the variants within genes (1-based inclusive), met through bins of positions."""
    binned = genes.select("gene", F.col("chrom"), "start", "end", F.explode(F.sequence(F.floor(F.col("start") / GENE_BIN), F.floor(F.col("end") / GENE_BIN))).alias("bin")).filter("start <= end")
    return variants.withColumn("bin", F.floor(F.col("pos") / GENE_BIN)).join(binned, ["chrom", "bin"]).filter(F.col("pos").between(F.col("start"), F.col("end"))).select("gene", "vid")


def gene_ld(calls: DataFrame | Tiles, variants: DataFrame, genes: DataFrame, min_r2: float = 1e-4) -> DataFrame:
    """(gene, a, b, r): correlations within genes (1-based inclusive) of at least min_r2, a <= b, with the diagonal."""
    inside = in_genes(variants, genes)
    pairs = inside.withColumnRenamed("vid", "a").join(inside.withColumnRenamed("vid", "b"), "gene").filter("a <= b")
    r = pair_r2(calls, pairs.select("a", "b").distinct()).filter(F.col("r2") >= min_r2)
    return pairs.join(r, ["a", "b"]).select("gene", "a", "b", "r")


def label_frequencies(calls: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, vid, p): allele frequency by label, kept within [1e-5, 1 - 1e-5]."""
    per = calls.filter("g is not null").join(labels, "sid").groupBy("label", "vid").agg((F.sum("g") / (2 * F.count("g"))).alias("p"))
    return per.withColumn("p", F.greatest(F.least("p", F.lit(1 - 1e-5)), F.lit(1e-5)))


def supervised_proportions(calls: DataFrame, frequencies: DataFrame, rounds: int = 200) -> DataFrame:
    """(sid, label, q): each sample's ancestry proportions by EM with the labels' frequencies held fixed.

    Only variants with a frequency in every label can take part.
    """
    names = [r.label for r in frequencies.select("label").distinct().orderBy("label").collect()]  # a row per label
    wide = frequencies.groupBy("vid").agg(F.transform(F.array_sort(F.collect_list(F.struct("label", "p"))), lambda x: x["p"]).alias("ps")).filter(F.size("ps") == len(names))
    rows = calls.filter("g is not null").join(wide, "vid").select("sid", "vid", F.col("g").cast("double").alias("g"), "ps")
    shown, kind = pa.array([str(n) for n in names]), calls.schema["sid"].dataType.simpleString()

    def em(part: pa.Table) -> pa.Table:  # a sample's calls
        order = np.argsort(part["vid"].to_numpy(), kind="stable")
        p, g = part["ps"].combine_chunks().flatten().to_numpy().reshape(-1, len(shown))[order], part["g"].to_numpy()[order]
        other, h = 1 - p, 2 - g
        q = np.full(p.shape[1], 1 / p.shape[1])
        for _ in range(rounds):
            new = q * ((g / (p @ q)) @ p + (h / (other @ q)) @ other) / (2 * len(g))
            done = np.abs(new - q).max() < 1e-6
            q = new
            if done:
                break
        return pa.table({"sid": pa.array([part["sid"][0].as_py()] * len(q), part.schema.field("sid").type), "label": shown, "q": q})

    return rows.groupBy("sid").applyInArrow(em, f"sid {kind}, label string, q double")
