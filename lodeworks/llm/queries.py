"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodeworks.llm.bpe_codec import op11_byte_bpe
from lodeworks.llm.decontaminate import OP3_SQL, op3_decontaminate
from lodeworks.llm.grading import op4_grading
from lodeworks.llm.host_rules import OP7_SQL, op7_host_rules
from lodeworks.llm.html_text import op8_html_text
from lodeworks.llm.lexical_rank import OP12_SQL, op12_lexical_rank
from lodeworks.llm.mixing import op6_mixing
from lodeworks.llm.near_dedup import op5_near_dedup
from lodeworks.llm.spelling import OP13_SQL, op13_spelling_variants
from lodeworks.llm.suffix_dedup import op10_suffix_dedup
from lodeworks.llm.token_shards import op1_token_shards
from lodeworks.llm.url_filter import OP2_SQL, op2_url_filter
from lodeworks.llm.warc import OP9_SQL, op9_warc

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, Query]:
    listed = [op1_token_shards, op2_url_filter, op3_decontaminate, op4_grading, op5_near_dedup, op6_mixing, op7_host_rules, op8_html_text, op9_warc, op10_suffix_dedup, op11_byte_bpe, op12_lexical_rank, op13_spelling_variants]
    return {f.__name__: f for f in listed}


def sql() -> dict[str, str]:
    return {"op2_url_filter": OP2_SQL, "op3_decontaminate": OP3_SQL, "op7_host_rules": OP7_SQL, "op9_warc": OP9_SQL, "op12_lexical_rank": OP12_SQL, "op13_spelling_variants": OP13_SQL}
