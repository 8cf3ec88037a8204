"""The queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tunesmith.llm import exact_dedup, lexical, line_dedup, resample
from tunesmith.llm.exact_dedup import op1_exact_dedup
from tunesmith.llm.jaccard import op3_jaccard_join
from tunesmith.llm.langid import op10_language_id
from tunesmith.llm.lexical import op12_lexical_search
from tunesmith.llm.line_dedup import op2_line_dedup
from tunesmith.llm.mixing import op9_mixing
from tunesmith.llm.packing import op8_packing
from tunesmith.llm.ppm import op11_lm_scoring
from tunesmith.llm.resample import op13_importance_resampling
from tunesmith.llm.sharding import op5_sharding
from tunesmith.llm.suffix_dedup import op4_suffix_dedup
from tunesmith.llm.token_output import op7_token_output
from tunesmith.llm.topk import op6_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sharding": op5_sharding,
    "op6_top_k": op6_top_k,
    "op7_token_output": op7_token_output,
    "op8_packing": op8_packing,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_lexical_search": op12_lexical_search,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op12_lexical_search": lexical.SQL,
    "op13_importance_resampling": resample.SQL,
}
