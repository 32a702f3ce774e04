"""Line dedup: drop lines that many documents share, keeping one holder.

Explode the lines, hash each normalised line, count the distinct documents of
each hash, drop the lines over the threshold from all but the largest
``doc_id`` that holds them, and put the documents together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import SPACE, ascii_lower, staged, unwrapped, wrapped

MIN_KEY_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """A line without outer ASCII white space, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_KEY_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text_col`` replaced and ``n_lines``, ``n_dropped`` added.

    - NULL or empty text: one empty line; the kept text is the empty string
      (a NULL text stays NULL in ``text_col``).
    - NULL id: not counted as a document and never the holder, but shared
      lines go from it as well.
    - Repeated ids are one document to the count; each row keeps its own lines.
    - A column of the input named like an added one is replaced; all others
      come through, whatever their names.

    Only line hashes are shuffled until the last join, which moves each text
    once. That join is on the id and a hash of the text, so no key is hot
    unless the same row is repeated, and then AQE splits it.
    """
    carry = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    base = wrapped(docs, carry, id=id_col, txt=text_col)
    text_hash = F.xxhash64(F.coalesce("txt", F.lit("")))
    # Two independent 64-bit hashes stand for the key.
    lines = (base.filter(F.char_length("txt") >= min_chars)
             .select("id", text_hash.alias("th"), F.posexplode(_lines(F.col("txt"))).alias("pos", "line"))
             .filter(F.char_length("line") >= min_chars)
             .select("id", "th", "pos", line_key(F.col("line")).alias("key"))
             .filter(F.char_length("key") >= min_chars)
             .select("id", "th", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2")))
    lines = staged(lines, "line-keys")
    shared = (lines.groupBy("k1", "k2")
              .agg(F.count_distinct("id").alias("docs"), F.max("id").alias("holder"))
              .filter(F.col("docs") >= min_docs).select("k1", "k2", "holder"))
    shared = staged(shared, "shared-lines")
    drops = (lines.join(shared, ["k1", "k2"])
             .filter(F.col("id").isNull() | (F.col("id") != F.col("holder")))
             .groupBy(F.col("id").alias("did"), F.col("th").alias("dth"))
             .agg(F.collect_set("pos").alias("gone")))
    joined = (base.withColumn("th", text_hash)
              .join(drops, F.col("id").eqNullSafe(F.col("did")) & (F.col("th") == F.col("dth")), "left")
              .withColumn("l", F.when(F.col("gone").isNotNull(), _lines(F.col("txt")))))
    kept_pos = F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("gone"))
    kept = F.array_join(F.transform(kept_pos, lambda i: F.get(F.col("l"), i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("txt")).otherwise(kept)
    own = [text.alias(c) if c == text_col else col for c, col in zip(carry, unwrapped(carry))]
    return joined.select(*own, F.size(_lines(F.col("txt"))).cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, rid, i, line,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
        FROM (SELECT doc_id, row_number() OVER () AS rid,
                     string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
s AS (
  SELECT key, max(doc_id) AS holder FROM l WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (
  SELECT l.*, s.key IS NOT NULL AND l.doc_id IS DISTINCT FROM s.holder AS gone
  FROM l LEFT JOIN s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM m GROUP BY doc_id, rid
"""
