"""Registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import (
    class_lm, collocations, exact_dedup, lexical_search, line_dedup, lz_fingerprint, mixing, simhash,
    topk_search, toxicity, url_filter, warc,
)
from tidewatch.llm.bpe import op9_bpe

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_warc": warc.op2_warc,
    "op3_simhash": simhash.op3_simhash,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_lz_fingerprint": lz_fingerprint.op6_lz_fingerprint,
    "op7_mixing": mixing.op7_mixing,
    "op8_class_lm": class_lm.op8_class_lm,
    "op9_bpe": op9_bpe,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_topk_search": topk_search.op11_topk_search,
    "op12_collocations": collocations.op12_collocations,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op2_warc": warc.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_url_filter": url_filter.oracle(),
    "op7_mixing": mixing.oracle(),
    "op11_topk_search": topk_search.ORACLE,
    "op12_collocations": collocations.oracle(),
    "op13_lexical_search": lexical_search.ORACLE,
}
