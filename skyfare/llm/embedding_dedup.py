"""Embedding near-dedup: random-hyperplane tables, exact cosine, components.

Equal vectors of a label are one representative with a weight. Each table
hashes the signs of ``bits`` projections; vectors that meet in a bucket of any
table are compared exactly, in double precision. A pair that meets in several
tables counts in the first one only, so no set of pairs is ever gathered:
every bucket yields link counts and a spanning forest of its links.

Bits and tables follow the largest label (``shape``): more vectors take more
bits, so buckets keep their size, and more bits take more tables, so the chance
of missing a link keeps its bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from skyfare.llm.common import arrow_batch, block_pairs, forest, staged, units
from skyfare.llm.components import connected_components

THRESHOLD = 0.93
# Chance of missing a pair at the threshold itself; closer pairs are missed less.
MISS = 3e-5
MIN_BITS, MAX_BITS = 4, 30
# Cost of moving a vector into one more table, in comparisons of two vectors.
MOVE_COST = 256
# Rows of one block; larger buckets are cut into blocks, compared two by two.
BLOCK = 512
SEED = 20_011


def shape(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(tables, bits) of least cost for a label of ``n`` vectors, among those
    that miss a pair at the threshold with a chance of at most ``miss``."""
    same = 1 - math.acos(min(1.0, threshold)) / math.pi  # both on one side of a plane
    best = None
    for bits in range(MIN_BITS, MAX_BITS + 1):
        meet = same ** bits
        tables = 1 if 1 - meet <= miss else math.ceil(math.log(miss) / math.log1p(-meet))
        cost = tables * (MOVE_COST + n / 2 ** bits)
        if best is None or cost < best[0]:
            best = cost, tables, bits
    return best[1], best[2]


def _planes(dim: int, tables: int, bits: int) -> np.ndarray:
    """Hyperplanes of a dimension; the seed fixes them for all tasks."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))


def _signatures(docs: DataFrame, tables: int, bits: int, real: str) -> DataFrame:
    """id, label, vec (bytes of type ``real``), sigs (4 bytes a table); unusable
    vectors have a NULL vec."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = (1 << np.arange(bits)).astype(np.int64)
        for b in batches:
            vecs, sigs = [], []
            for v in b.column("v").to_pylist():
                x = None
                if v and all(c is not None for c in v):
                    x = np.asarray(v, np.float64)
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                if x is None:
                    vecs.append(None)
                    sigs.append(None)
                    continue
                d = len(x)
                if d not in planes:
                    planes[d] = _planes(d, tables, bits)
                x = x + 0.0  # -0.0 and 0.0 are one value
                scaled = x / np.abs(x).max()
                side = (scaled @ planes[d]).reshape(tables, bits) >= 0
                vecs.append(x.astype(real).tobytes())
                sigs.append((side @ weight).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), b.column("l"), pa.array(vecs, pa.binary()),
                 pa.array(sigs, pa.binary())], ["i", "l", "vec", "sigs"])

    i, l = docs.schema["i"].dataType.simpleString(), docs.schema["l"].dataType.simpleString()
    return docs.mapInArrow(run, f"i {i}, l {l}, vec binary, sigs binary")


def _unit(rows: list[bytes], real: str) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), real).reshape(len(rows), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(block: list[dict], threshold: float, real: str) -> tuple[dict, list]:
    """Link counts and forest of one block, or of a pair of blocks."""
    table = block[0]["t"]
    unit = _unit([r["vec"] for r in block], real)
    links = unit @ unit.T >= threshold
    np.fill_diagonal(links, False)
    if not links.any():
        return {}, []
    sigs = np.frombuffer(b"".join(r["sigs"] for r in block), np.int32).reshape(len(block), -1)
    side = np.array([r["side"] for r in block])
    ids = np.array([r["rep"] for r in block], np.int64)
    weight = np.array([r["weight"] for r in block], np.int64)
    if side.any():  # two blocks: only pairs across them
        links &= side[:, None] != side[None, :]
    a, b = np.nonzero(links)
    if table and len(a):
        fresh = ~(sigs[a, :table] == sigs[b, :table]).any(axis=1)
        links = np.zeros_like(links)
        links[a[fresh], b[fresh]] = True
    counts = links @ weight
    hit = np.flatnonzero(counts)
    return dict(zip(ids[hit].tolist(), counts[hit].tolist())), forest(links, ids)


def _buckets(reps: DataFrame, tables: int, threshold: float, block: int, real: str) -> DataFrame:
    """(a, b, n): for n > 0, n links of ``a``; for n = 0, a link a-b."""
    rows = (reps.select("l", "dim", "rep", "weight", "vec", "sigs",
                        F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("t"))
            .withColumn("s", F.expr("substring(sigs, 4 * t + 1, 4)")))
    key = ["l", "dim", "t", "s"]
    unit = [*key, "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in units(batches, unit):
            a, b, n = [], [], []
            for g in groups:
                if len(g) < 2:
                    continue
                counts, tree = _compare(g, threshold, real)
                for k, v in counts.items():
                    a.append(k), b.append(None), n.append(v)
                for u, v in tree:
                    a.append(u), b.append(v), n.append(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())],
                ["a", "b", "n"])

    return block_pairs(rows, key, "rep", block).mapInArrow(run, "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD, miss: float = MISS,
                    block: int = BLOCK) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    - Only rows of one non-NULL label and one dimension are compared.
    - A NULL, empty or zero vector, or one with a NULL or non-finite component,
      links with nothing: n_links 0 and its own component.
    - Equal vectors link with each other. A repeated id is one node of the
      graph; each of its rows counts as a vector and is returned.
    - A NULL id gets NULL component_id and kept, and links with nothing.
    - Other columns are not carried; an empty table gives an empty result.

    Every reported link is exact. A pair at the threshold itself is missed by
    all tables with a chance of (1 - p^bits)^tables, p = 1 - acos(t) / pi, which
    ``miss`` bounds at any size of table. The size of the largest label reaches
    the driver.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).alias("l"),
                          F.col(vec_col).alias("v"))
    spark = vectors.sparkSession
    real = "<f4" if rows.schema["v"].dataType.elementType == FloatType() else "<f8"
    largest = rows.filter("l IS NOT NULL").groupBy("l").count().agg(F.max("count")).first()[0] or 0
    tables, bits = shape(largest, threshold, miss)
    with arrow_batch(spark, 2000):
        signed = staged(_signatures(rows, tables, bits, real), "signatures")
        usable = signed.filter(F.col("vec").isNotNull() & F.col("l").isNotNull() & F.col("i").isNotNull())
        key = [F.col("l"), F.octet_length("vec").alias("dim"), F.xxhash64("vec").alias("h1"),
               F.xxhash64(F.lit(1), "vec").alias("h2")]
        member = staged(usable.select("i", *key), "members")
        reps = staged(usable.select("i", *key, "vec", "sigs").groupBy("l", "dim", "h1", "h2").agg(
            F.min("i").alias("rep"), F.count("*").alias("weight"), F.first("vec").alias("vec"),
            F.first("sigs").alias("sigs")), "representatives")
        found = staged(_buckets(reps, tables, threshold, block, real), "links-found")
    counts = staged(reps.select("l", "dim", "h1", "h2", "rep", "weight")
                    .join(found.filter("n > 0").groupBy(F.col("a").alias("rep"))
                          .agg(F.sum("n").alias("n")), "rep", "left"), "rep-links")
    same = counts.select("l", "dim", "h1", "h2", "rep", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1)
                         .alias("n_links"))
    joined = staged(member.join(same, ["l", "dim", "h1", "h2"]).select("i", "rep", "n_links"), "member-links")
    links = found.filter("n = 0").select("a", "b").union(
        joined.filter("i != rep").select(F.col("i").alias("a"), F.col("rep").alias("b")))
    comp = staged(connected_components(links, "a", "b"), "components")
    linked = joined.groupBy("i").agg(F.max("n_links").alias("n_links"))
    return (signed.select("i").join(linked, "i", "left")
            .join(comp.withColumnRenamed("node", "i"), "i", "left")
            .select(F.col("i").cast(vectors.schema[id_col].dataType).alias(id_col),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "i").cast("long").alias("component_id"))
            .withColumn("kept", F.col(id_col) == F.col("component_id")))


def digest(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors.select("vec_id", "embedding", "label"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach(a, b) AS (
  SELECT DISTINCT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
c AS (
  SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(least_of.b, vec_id)) AS component_id
  FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM c
"""
