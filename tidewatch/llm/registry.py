"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe, chat, ctw, fingerprints, packing, quality, simhash_dedup, topk, toxicity, urlfilter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ctw": ctw.op1_ctw,
        "op2_fingerprints": fingerprints.op2_fingerprints,
        "op3_bpe": bpe.op3_bpe,
        "op4_topk": topk.op4_topk,
        "op5_urlfilter": urlfilter.op5_urlfilter,
        "op6_chat": chat.op6_chat,
        "op7_quality": quality.op7_quality,
        "op8_packing": packing.op8_packing,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_simhash_dedup": simhash_dedup.op10_simhash_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_topk": topk.OP4_SQL, "op5_urlfilter": urlfilter.OP5_SQL, "op6_chat": chat.OP6_SQL}
