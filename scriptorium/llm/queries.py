"""Queries of the operators and of the corpus pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm.bpe_codec import op2_bpe_codec
from scriptorium.llm.centroids import OP11_SQL, op11_centroid_clustering
from scriptorium.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from scriptorium.llm.filter_audit import OP13_SQL, op13_filter_interaction_audit
from scriptorium.llm.language_id import op4_language_id
from scriptorium.llm.license_scan import op1_license_scan
from scriptorium.llm.lm_score import op6_lm_score
from scriptorium.llm.packing import op10_packing
from scriptorium.llm.secret_scan import OP12_SQL, op12_secret_scan
from scriptorium.llm.simhash import op8_simhash
from scriptorium.llm.suffix_dedup import op7_suffix_dedup
from scriptorium.llm.token_counts import op5_token_counts
from scriptorium.llm.topk import OP3_SQL, op3_topk


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_topk": op3_topk,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_lm_score": op6_lm_score,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_simhash": op8_simhash,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_secret_scan": op12_secret_scan,
    "op13_filter_interaction_audit": op13_filter_interaction_audit,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op3_topk": OP3_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_centroid_clustering": OP11_SQL,
    "op12_secret_scan": OP12_SQL,
    "op13_filter_interaction_audit": OP13_SQL,
}
