"""The registered queries of this subpackage."""

from __future__ import annotations

from tallybrook.llm import lexical_scan, line_dedup, mixing, queries, spelling, url_filter
from tallybrook.plans.tables import Query

QUERIES: dict[str, Query] = {
    "op1_quality_rules": Query(queries.op1_quality_rules),
    "op2_language_id": Query(queries.op2_language_id),
    "op3_url_filter": Query(queries.op3_url_filter, url_filter.SQL),
    "op4_near_duplicates": Query(queries.op4_near_duplicates),
    "op5_byte_bpe": Query(queries.op5_byte_bpe),
    "op6_line_dedup": Query(queries.op6_line_dedup, line_dedup.SQL),
    "op7_lattice_lm": Query(queries.op7_lattice_lm),
    "op8_sharding": Query(queries.op8_sharding),
    "op9_prefix_forest": Query(queries.op9_prefix_forest),
    "op10_source_mixing": Query(queries.op10_source_mixing, mixing.SQL),
    "op11_spelling_variants": Query(queries.op11_spelling_variants, spelling.SQL),
    "op12_html_text": Query(queries.op12_html_text),
    "op13_lexical_search": Query(queries.op13_lexical_search, lexical_scan.SQL),
}
