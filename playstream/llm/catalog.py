"""Queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from playstream.llm.covertree import SQL as OP11, op11_embedding_near_dedup
from playstream.llm.decontaminate import SQL as OP8, op8_benchmark_decontamination
from playstream.llm.html import op4_html_extraction
from playstream.llm.licenses import op5_license_scan
from playstream.llm.lines import op9_line_dedup
from playstream.llm.middle import SQL as OP13, op13_fill_in_middle
from playstream.llm.packing import op7_best_fit_packing
from playstream.llm.phrases import SQL as OP12, op12_phrase_collocations
from playstream.llm.quality import op1_quality_classifier
from playstream.llm.rules import op10_quality_rules
from playstream.llm.secrets import op3_secret_scan
from playstream.llm.simhash import op2_simhash_near_dedup
from playstream.llm.substrings import SQL as OP6, op6_suffix_array_dedup

QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_simhash_near_dedup, op3_secret_scan, op4_html_extraction, op5_license_scan,
    op6_suffix_array_dedup, op7_best_fit_packing, op8_benchmark_decontamination, op9_line_dedup, op10_quality_rules,
    op11_embedding_near_dedup, op12_phrase_collocations, op13_fill_in_middle)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE = {"op6_suffix_array_dedup": OP6, "op8_benchmark_decontamination": OP8, "op11_embedding_near_dedup": OP11, "op12_phrase_collocations": OP12,
          "op13_fill_in_middle": OP13}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
