"""One registered query for each operator, over its whole table, with its SQL."""

from __future__ import annotations

import public_tokenizers

from skyfare.llm import (bpe, embedding_dedup, fill_middle, jaccard_join, language_id, line_dedup,
                         packing, phrases, quality_rules, quotation, sharding, token_counts, url_filter)
from skyfare.llm.common import table


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op2_language_id(spark, sf_dir):
    return language_id.digest(table(spark, sf_dir, "documents"))


def op3_bpe(spark, sf_dir):
    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.digest(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark, sf_dir):
    return embedding_dedup.digest(table(spark, sf_dir, "embeddings"))


def op6_sharding(spark, sf_dir):
    return sharding.digest(table(spark, sf_dir, "documents"))


def op7_quotation_linking(spark, sf_dir):
    return quotation.digest(table(spark, sf_dir, "conversations"))


def op8_quality_rules(spark, sf_dir):
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op9_packing(spark, sf_dir):
    return packing.digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_url_filter(spark, sf_dir):
    return url_filter.digest(table(spark, sf_dir, "pages"))


def op11_token_counts(spark, sf_dir):
    return token_counts.digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_fill_middle(spark, sf_dir):
    return fill_middle.digest(table(spark, sf_dir, "documents"))


def op13_phrases(spark, sf_dir):
    return phrases.digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_language_id, op3_bpe, op4_jaccard_join, op5_embedding_dedup, op6_sharding,
    op7_quotation_linking, op8_quality_rules, op9_packing, op10_url_filter, op11_token_counts,
    op12_fill_middle, op13_phrases)}

ORACLE = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op4_jaccard_join": jaccard_join.ORACLE_SQL,
    "op5_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op7_quotation_linking": quotation.ORACLE_SQL,
    "op10_url_filter": url_filter.ORACLE_SQL,
    "op12_fill_middle": fill_middle.ORACLE_SQL,
    "op13_phrases": phrases.ORACLE_SQL,
}
