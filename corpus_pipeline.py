"""Corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns what it keeps with the
columns of ``documents``; the last returns packed pieces. Stages are written
as Parquet and read again by the next one, so each starts from files and a
lost executor repeats one stage's work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.llm import jaccard_join, language_id, line_dedup, packing, quality_rules
from skyfare.llm.common import staged, table
from skyfare.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A text whose language stays in doubt below this score goes; clean prose of
# any length lies far above it.
MIN_LANGUAGE_SCORE = 0.3
# Word shingles of near-duplicates, and their similarity in percent.
SHINGLE, PERCENT = 5, 80


def _hidden(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns beyond ``COLUMNS`` in one struct, where their
    names can clash with nothing that a stage adds."""
    extra = [F.col(f"`{c}`") for c in docs.columns if c not in COLUMNS]
    return docs.select(*COLUMNS, F.struct(*extra).alias("_extra")) if extra else docs.select(*COLUMNS)


def _shown(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """``kept`` with the columns of ``docs``, in their order."""
    return kept.select(*[c if c in COLUMNS else F.col(f"_extra.`{c}`").alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are no outliers.

    NULL, empty and very short texts go (they have under ten words). Very long
    texts are judged whole. Repeated rows fall together. NULL languages and
    sources are groups of their own; NULL ids do not matter. An empty table
    stays empty, and columns of any name come through unchanged.
    """
    rows = _hidden(docs)
    return _shown(quality_rules.quality_rules(rows, carry=rows.columns).filter("kept"), docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; the given ``lang`` is kept, not replaced.

    NULL, empty and letterless texts go (``und``); if no row has a language to
    learn from, all rows do. Very long texts are read whole. Repeated rows fall
    together. NULL ids are judged like any other. An empty table stays empty,
    and columns of any name come through unchanged.
    """
    said = language_id.identify(_hidden(docs))
    return _shown(said.filter((F.col("lang_pred") != language_id.UNKNOWN)
                              & (F.col("score") >= MIN_LANGUAGE_SCORE)), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows.

    Every row stays. A NULL text stays NULL and an empty one empty; a text that
    loses all its lines becomes empty. Of equal largest ids each row keeps the
    line. Rows without an id lose shared lines and are never the holder. Only
    rows that lost a line get a new ``n_chars``. An empty table stays empty,
    and columns of any name come through unchanged.
    """
    kept = line_dedup.dedup_lines(_hidden(docs))
    return _shown(kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long"))
                                  .otherwise(F.col("n_chars"))), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Rows of one id stay or go together, and rows without an id stay. NULL,
    empty and wordless texts link with nothing, so all of them stay; a text of
    fewer than five words links with its equals. Very long texts are compared
    whole. An empty table stays empty, and columns of any name come through
    unchanged.
    """
    linked = jaccard_join.link_documents(docs.select("doc_id", "text"), size=SHINGLE, percent=PERCENT)
    copies = linked.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return _shown(_hidden(docs).join(copies, "doc_id", "left_anti"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens.

    NULL and empty texts are one piece, the end id alone. A very long text is
    cut into as many pieces as it needs; repeated rows are packed each. Only
    ``doc_id`` is carried, so other columns do not matter. An empty table has
    no pieces.
    """
    return packing.digest(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("packing", pack),
]

# Learned languages and token ids have no SQL; the tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
