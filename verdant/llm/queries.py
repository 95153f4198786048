"""Registered queries of this subpackage: (spark, data_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from verdant.llm import (cuckoo, fill_middle, language_id, licenses, mixing, ngram_join, packing, periodic_runs, quality,
                         suffix_dedup, url_rules, vector_files, warc)
from verdant.sources.tables import table

#: The vocabulary that the packing query reads.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": lambda s, d: warc.op1_warc(table(s, d, "pages")),
    "op2_url_rules": lambda s, d: url_rules.op2_url_rules(table(s, d, "pages")),
    "op3_packing": lambda s, d: packing.op3_packing(table(s, d, "documents"), TOKENIZER),
    "op4_suffix_dedup": lambda s, d: suffix_dedup.op4_suffix_dedup(table(s, d, "documents")),
    "op5_license_scan": lambda s, d: licenses.op5_license_scan(table(s, d, "documents")),
    "op6_ngram_join": lambda s, d: ngram_join.op6_ngram_join(table(s, d, "documents")),
    "op7_quality_classifier": lambda s, d: quality.op7_quality_classifier(table(s, d, "documents"), table(s, d, "labels")),
    "op8_exact_dedup": lambda s, d: cuckoo.op8_exact_dedup(table(s, d, "documents")),
    "op9_top_k": lambda s, d: vector_files.op9_top_k(table(s, d, "embeddings")),
    "op10_mix_sources": lambda s, d: mixing.op10_mix_sources(table(s, d, "documents")),
    "op11_periodic_runs": lambda s, d: periodic_runs.op11_periodic_runs(table(s, d, "documents")),
    "op12_language_id": lambda s, d: language_id.op12_language_id(table(s, d, "documents")),
    "op13_fill_middle": lambda s, d: fill_middle.op13_fill_middle(table(s, d, "documents")),
}

LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_warc": warc.ORACLE,
    "op2_url_rules": url_rules.ORACLE,
    "op5_license_scan": licenses.ORACLE,
    "op8_exact_dedup": f"""
WITH r AS (SELECT doc_id, sha256({LOWER_AZ}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM r WINDOW w AS (PARTITION BY text_sha256)""",
    "op9_top_k": vector_files.ORACLE,
    "op10_mix_sources": mixing.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
