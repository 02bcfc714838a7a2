"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardsentry.llm import (
    bpe, decontaminate, html_text, language, merkle, minhash, mixing, neighbours, pivots, quality, secrets, suffix,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix": suffix.op1_suffix,
    "op2_mix": mixing.op2_mix,
    "op3_language": language.op3_language,
    "op4_html": html_text.op4_html,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_secrets": secrets.op6_secrets,
    "op7_bpe": bpe.op7_bpe,
    "op8_minhash": minhash.op8_minhash,
    "op9_quality": quality.op9_quality,
    "op10_neighbours": neighbours.op10_neighbours,
    "op11_manifest": merkle.op11_manifest,
    "op12_contamination": decontaminate.op12_contamination,
    "op13_clusters": pivots.op13_clusters,
}
ORACLE_SQL: dict[str, str] = {
    "op2_mix": mixing.OP2_SQL,
    "op6_secrets": secrets.OP6_SQL,
    "op9_quality": quality.OP9_SQL,
    "op11_manifest": merkle.OP11_SQL,
    "op12_contamination": decontaminate.OP12_SQL,
    "op13_clusters": pivots.OP13_SQL,
}
