"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import langid, lexicon, licenses, media, merkle, packing, passages, permuterm, quality, simhash, thresholds, topk, toxicity
from helixframe.llm.common import keep, scratch


def settled(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """query with its result stored and every other table it wrote deleted: for results that are small beside those."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch(spark):
            return keep(query(spark, sf_dir), query.__name__, hold=True)

    return run


QUERIES = {
    "op1_toxicity_chain": toxicity.op1_toxicity_chain,
    "op2_bpe_lexicon": lexicon.op2_bpe_lexicon,
    "op3_media_columns": settled(media.op3_media_columns),
    "op4_language_id": langid.op4_language_id,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_substring_dedup": passages.op6_substring_dedup,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_simhash_golay": simhash.op8_simhash_golay,
    "op9_topk_threshold": topk.op9_topk_threshold,
    "op10_quality_lines": quality.op10_quality_lines,
    "op11_risk_thresholds": settled(thresholds.op11_risk_thresholds),
    "op12_permuterm_variants": settled(permuterm.op12_permuterm_variants),
    "op13_merkle_veb": settled(merkle.op13_merkle_veb),
}
ORACLES = {
    "op5_license_scan": licenses.ORACLE_SQL,
    "op9_topk_threshold": topk.ORACLE_SQL,
    "op11_risk_thresholds": thresholds.ORACLE_SQL,
    "op12_permuterm_variants": permuterm.ORACLE_SQL,
    "op13_merkle_veb": merkle.ORACLE_SQL,
}
