"""Queries of the pipeline operators over the test tables, and their DuckDB SQL."""

from __future__ import annotations

from cartwheel.llm.decontamination import OP7_SQL, op7_benchmark_windows
from cartwheel.llm.filter_audit import OP11_SQL, op11_filter_interactions
from cartwheel.llm.html_density import OP12_SQL, op12_page_text
from cartwheel.llm.jaccard_join import OP3_SQL, op3_jaccard_components
from cartwheel.llm.language_id import op2_page_languages
from cartwheel.llm.lexical_search import OP13_SQL, op13_ranked_search
from cartwheel.llm.line_dedup import op6_line_dedup
from cartwheel.llm.packing import op8_length_buckets
from cartwheel.llm.pivot_index import OP4_SQL, op4_near_vectors
from cartwheel.llm.repeated_bytes import op5_repeated_bytes
from cartwheel.llm.secret_scan import OP9_SQL, op9_secret_spans
from cartwheel.llm.toxicity import op1_toxicity
from cartwheel.llm.warc import OP10_SQL, op10_warc_records

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_page_languages": op2_page_languages,
    "op3_jaccard_components": op3_jaccard_components,
    "op4_near_vectors": op4_near_vectors,
    "op5_repeated_bytes": op5_repeated_bytes,
    "op6_line_dedup": op6_line_dedup,
    "op7_benchmark_windows": op7_benchmark_windows,
    "op8_length_buckets": op8_length_buckets,
    "op9_secret_spans": op9_secret_spans,
    "op10_warc_records": op10_warc_records,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_page_text": op12_page_text,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL = {
    "op3_jaccard_components": OP3_SQL,
    "op4_near_vectors": OP4_SQL,
    "op7_benchmark_windows": OP7_SQL,
    "op9_secret_spans": OP9_SQL,
    "op10_warc_records": OP10_SQL,
    "op11_filter_interactions": OP11_SQL,
    "op12_page_text": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
