"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faturaflow.llm import (
    chat,
    exact_dedup,
    lexical,
    mixing,
    packing,
    periodic,
    quality,
    secrets,
    simhash,
    substring,
    suffix_sort,
    toxicity,
    warc,
)
from faturaflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _on(name: str, f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(table(spark, sf_dir, name))


REGISTRY: dict[str, Query] = {
    "op1_chat": _on("conversations", chat.op1_chat),
    "op2_quality": lambda spark, sf_dir: quality.op2_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op3_pack": _on("documents", packing.op3_pack),
    "op4_warc": _on("pages", warc.op4_warc),
    "op5_toxicity": lambda spark, sf_dir: toxicity.op5_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op6_secrets": _on("documents", secrets.op6_secrets),
    "op7_exact_dedup": _on("documents", exact_dedup.op7_exact_dedup),
    "op8_simhash": _on("documents", simhash.op8_simhash),
    "op9_substring": _on("documents", substring.op9_substring),
    "op10_mix": _on("documents", mixing.op10_mix),
    "op11_suffix": _on("documents", suffix_sort.op11_suffix),
    "op12_search": lambda spark, sf_dir: lexical.op12_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
    "op13_runs": _on("documents", periodic.op13_runs),
}

SQL: dict[str, str] = {
    "op1_chat": chat.SQL,
    "op4_warc": warc.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op10_mix": mixing.SQL,
    "op12_search": lexical.SQL,
}
