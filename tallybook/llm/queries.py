"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallybook.llm import (
    bpe,
    ctph,
    fim,
    langid,
    line_spread,
    mixing,
    mtree,
    near_vectors,
    pii,
    simhash,
    suffixes,
    toxicity,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": toxicity.query,
        "op2_pii": pii.query,
        "op3_language": langid.query,
        "op4_suffix_dedup": suffixes.query,
        "op5_simhash": simhash.query,
        "op6_topk": mtree.query,
        "op7_bpe": bpe.query,
        "op8_fingerprints": ctph.query,
        "op9_line_dedup": line_spread.query,
        "op10_mixing": mixing.query,
        "op11_near_vectors": near_vectors.query,
        "op12_vector_codes": vector_codes.query,
        "op13_fim": fim.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    statements = {
        "op6_topk": mtree.ORACLE_SQL,
        "op9_line_dedup": line_spread.ORACLE_SQL,
        "op11_near_vectors": near_vectors.ORACLE_SQL,
        "op12_vector_codes": vector_codes.ORACLE_SQL,
        "op13_fim": fim.ORACLE_SQL,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: sql for name, sql in statements.items() if sql}
