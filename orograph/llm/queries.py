"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from .decontamination import ORACLE as _OP3
from .decontamination import op3_suffix_array
from .html_text import op1_host_suffix_array
from .language_id import op10_byte_gru
from .packing import op7_nnls_packing
from .quality_rules import op9_decision_list
from .sharding import op2_hypergeometric
from .simhash import op8_simhash_blocks
from .surrogates import op6_surrogates
from .toxicity import op4_noisy_or
from .warc import ORACLE as _OP5
from .warc import op5_chunked_records


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_host_suffix_array": op1_host_suffix_array,
        "op2_hypergeometric": op2_hypergeometric,
        "op3_suffix_array": op3_suffix_array,
        "op4_noisy_or": op4_noisy_or,
        "op5_chunked_records": op5_chunked_records,
        "op6_surrogates": op6_surrogates,
        "op7_nnls_packing": op7_nnls_packing,
        "op8_simhash_blocks": op8_simhash_blocks,
        "op9_decision_list": op9_decision_list,
        "op10_byte_gru": op10_byte_gru,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_suffix_array": _OP3, "op5_chunked_records": _OP5}
