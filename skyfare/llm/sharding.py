"""Sharding: size-balanced range partitions from sampled splitters.

Rows are ordered by (hash of the text, then, within hot texts, the id and the
row), so equal texts lie side by side. Splitters come from a size-weighted sample of those
keys; the fine ranges they cut are measured exactly, overfull ones are cut
again, and running byte totals over the ranges place every row in the shard
that its byte offset falls in. Equal texts share a shard unless their group
alone exceeds ``hot_share`` of a shard; only such a group is spread.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.llm.common import staged

SHARDS = 8
RANGES_PER_SHARD = 32       # at least
ROWS_PER_RANGE = 1 << 22    # about; one task sorts their keys and sizes
SAMPLES_PER_RANGE = 24
HOT_SHARE = 0.01
KEY = ("_k", "_sub", "_salt")


def _splitters(keys: DataFrame, step: float) -> list:
    """Quantile boundaries: one key of about every ``step`` bytes, drawn with a
    chance proportional to the row's size. Bounded by total bytes / step."""
    per = step / SAMPLES_PER_RANGE
    u = F.pmod(F.xxhash64(F.lit(7), "_k", "_row"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = keys.filter(u < F.col("size") / F.lit(per)).select(*KEY)
    ordered = sorted(tuple(r) for r in sample.collect())
    return sorted(set(ordered[SAMPLES_PER_RANGE - 1::SAMPLES_PER_RANGE]))


def _longs(values) -> Column:
    """A literal array of longs, made by one call however long it is."""
    return F.split(F.lit(" ".join(map(str, values))), " ").cast("array<bigint>")


def _range_of(splitters: list) -> Column:
    """Number of splitters at or below the key: a binary search in sorted
    literal arrays, one for each part of the key, so that the expression keeps
    its size however many splitters there are."""
    if not splitters:
        return F.lit(0)
    parts = [_longs(part) for part in zip(*splitters, strict=True)]
    steps = [1 << t for t in reversed(range(len(splitters).bit_length()))]

    def ahead(found: Column, step: Column) -> Column:
        # Past the end the splitter is NULL, and the step not taken.
        k, sub, salt = (F.get(part, found + step - F.lit(1)) for part in parts)
        at_or_below = (k < F.col("_k")) | ((k == F.col("_k")) & (
            (sub < F.col("_sub")) | ((sub == F.col("_sub")) & (salt <= F.col("_salt")))))
        return F.when(at_or_below, found + step).otherwise(found)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), ahead)


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shards: int = SHARDS, hot_share: float = HOT_SHARE,
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot.

    - ``size``: UTF-8 bytes of the text plus 1; a NULL text has none, and its
      crc32 is that of the empty string.
    - ``slot`` counts from 0 without gaps in each shard.
    - NULL ids and repeated rows are placed like any other row; rows that tie
      on every key may swap slots among themselves, which changes nothing.
    - Sizes: a group goes where its first byte falls, so the bytes of a shard
      differ from an equal share by less than the larger of ``hot_share`` of it
      and its largest text, at either end.
    - No rows in, no rows out. Other input columns are not carried.

    There are 32 ranges a shard, more where a range would hold more than about
    ``rows_per_range`` rows, so no task sorts a fixed share of the table. What
    reaches the driver: the totals, the sampled keys (about 24 a range, and as
    many again of overfull ones), and one line a range: of 10^10 rows some
    2,400 ranges and 60,000 keys.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_k"), F.xxhash64(F.lit(1), text).alias("_k2"),
        F.monotonically_increasing_id().alias("_row")), "shard-rows")
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    out = ["_id", "size", "text_crc32"]
    if not total:
        return rows.select(F.col("_id").alias(id_col), *out[1:], F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"))
    share = total / shards
    # At most shards / hot_share groups can be hot.
    hot = (rows.groupBy("_k").agg(F.sum("size").alias("_g"))
           .filter(F.col("_g") > hot_share * share).select("_k"))
    hot_keys = [r[0] for r in hot.collect()]
    spread = F.col("_k").isin(hot_keys) if hot_keys else F.lit(False)
    # Repeated rows have one id or none, so the row itself comes last.
    keys = rows.withColumns({
        "_sub": F.when(spread, F.xxhash64(F.lit(3), "_id")).otherwise(F.lit(0)).cast("long"),
        "_salt": F.when(spread, F.xxhash64(F.lit(4), "_row")).otherwise(F.lit(0)).cast("long")})
    per_range = share / max(RANGES_PER_SHARD, -(-n_rows // (shards * rows_per_range)))
    splitters = _splitters(keys, per_range)
    ranged = keys.withColumn("_range", _range_of(splitters))
    found = ranged.groupBy("_range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    overfull = [r["_range"] for r in found if r["b"] > 2 * per_range]
    if overfull:
        # Subdivide: a denser sample of the overfull ranges alone.
        more = _splitters(ranged.filter(F.col("_range").isin(overfull)), per_range / 4)
        splitters = sorted({*splitters, *more})
        ranged = keys.withColumn("_range", _range_of(splitters))
        found = (ranged.groupBy("_range")
                 .agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect())
    held = {r["_range"]: (r["b"], r["n"]) for r in found}
    sizes, counts = zip(*(held.get(i, (0, 0)) for i in range(len(splitters) + 1)), strict=True)
    bytes_before = F.get(_longs(accumulate(sizes, initial=0)), F.col("_range"))
    rows_before = F.get(_longs(accumulate(counts, initial=0)), F.col("_range"))
    in_range = Window.partitionBy("_range").orderBy(*KEY, "_k2", "_id")
    group = Window.partitionBy("_range", *KEY)
    placed = (ranged
              .withColumn("_at", bytes_before - F.col("size") + F.sum("size").over(
                  in_range.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_rank", rows_before + F.row_number().over(in_range) - 1)
              # A group goes whole where its first byte falls.
              .withColumn("_at", F.min("_at").over(group))
              .withColumn("shard", F.least(F.floor(F.col("_at") * shards / F.lit(total)),
                                           F.lit(shards - 1)).cast("int")))
    placed = staged(placed.select(*out, "shard", "_rank"), "shard-placed")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("_rank").alias("_first")))
    return (placed.join(first, "shard")
            .select(F.col("_id").alias(id_col), "size", "text_crc32", "shard",
                    (F.col("_rank") - F.col("_first")).alias("slot")))


def digest(docs: DataFrame) -> DataFrame:
    return shard_by_bytes(docs.select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
