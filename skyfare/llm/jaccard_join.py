"""N-gram Jaccard join with adaptive multi-match prefixes.

Every document becomes its set of word shingles, held as 64-bit hashes in one
global order, rarest first. Two sets that reach the threshold share at least
``o`` shingles, so their prefixes of ``n - o + m`` shingles share at least
``m``. Each document picks its own ``m``: a longer prefix costs more postings,
more required matches leave fewer candidates to verify; both are estimated
from a table of shingle counts. A pair needs the smaller ``m`` of the two.
The smaller set of a pair must be covered further, so it is looked up by a
shorter prefix (its index part); only the larger one needs the whole of it.

Verification is exact and only the links that components need are verified:
first each posting list against one of its members, which joins whole groups of
copies with a number of pairs linear in the postings; then every remaining pair
that lies across two components, with the matches counted. Documents that meet
in a very long list are compared in bounded blocks instead of being paired.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import arrow_batch, block_pairs, discard, forest, staged, units
from skyfare.llm.components import connected_components

SHINGLE = 4
PERCENT = 85
MAX_MATCHES = 4
# Cells of the shingle count table: fixed, so it has one size (4 MB) at any
# input. Counts are upper bounds; the order they give is a total one whatever
# collides, so they affect cost and never the result.
CELLS = 1 << 20
BLOCKS = 64
# Cost of verifying one candidate, in postings read.
VERIFY_COST = 20.0
# Rounds of star pairs before the pairs that are left are enumerated.
STAR_ROUNDS = 3
# Lists with more index postings than this are not joined with themselves:
# their documents are compared in blocks, which return links and no pairs.
HOT_LIST = 128
BLOCK = 256
# Columns of the membership matrix held at a time.
MATRIX_COLUMNS = 16_384

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text; of the whole
    sequence if it has fewer words; none without words."""
    words = (text or "").encode().lower().split()  # ASCII rules on bytes
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    w = np.fromiter(map(digest, words), np.uint64, len(words))
    k = min(size, len(words))
    h = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ w[i:len(words) - k + 1 + i]) * _MIX
        h ^= h >> np.uint64(29)
    return np.unique(h)


def overlap(n: np.ndarray | int, percent: int):
    """Least intersection a set of ``n`` has with any set it links with."""
    return -(-(n * percent) // 100)


def index_overlap(n: int, percent: int) -> int:
    """Least intersection it has with one that is not smaller."""
    return -(-(2 * n * percent) // (100 + percent))


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(44)).astype(np.int64)


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """One pass over the texts: a row (id, n, h1, h2) for each document, and at
    the end of each task one row with the task's shingle counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.uint32)
        names = ["i", "n", "h1", "h2", "counts"]
        for b in batches:
            n, h1, h2 = [], [], []
            for t in b.column("t"):
                s = shingles(t.as_py(), size)
                np.add.at(counts, _cells(s), 1)
                raw = s.tobytes()
                n.append(len(s))
                h1.append(np.uint64(xxhash.xxh64_intdigest(raw, 1)).astype(np.int64))
                h2.append(np.uint64(xxhash.xxh64_intdigest(raw, 2)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.nulls(len(n), pa.binary())], names)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
             pa.nulls(1, pa.int64()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names)

    return docs.mapInArrow(run, "i bigint, n bigint, h1 bigint, h2 bigint, counts binary")


def _merge_counts(scanned: DataFrame) -> np.ndarray:
    """Sum of the tasks' count tables. Each is cut into ``BLOCKS`` blocks, which
    are summed apart, so no task adds up more than its share of every table;
    only the ``CELLS`` sums reach the driver."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.frombuffer(zlib.decompress(x.as_py()), np.uint32)
        parts = total.reshape(BLOCKS, -1)
        held = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()),
             pa.array([zlib.compress(parts[i].tobytes(), 1) for i in held], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(zlib.decompress(x.as_py()), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes() for v in sums.values()],
                      pa.binary())], ["block", "counts"])

    kind = "block int, counts binary"
    out = np.zeros((BLOCKS, CELLS // BLOCKS), np.uint32)
    for r in (scanned.filter("counts IS NOT NULL").select("counts").mapInArrow(cut, kind)
              .repartition(BLOCKS, "block").mapInArrow(add, kind).collect()):
        out[r["block"]] = np.frombuffer(r["counts"], np.uint32)
    return out.ravel()


def _prefix(s: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """(prefix, m): the rarest shingles of a set, as many as its own choice of
    required matches calls for."""
    n = len(s)
    freq = counts[_cells(s)]
    order = np.lexsort((s, freq))
    base = n - int(overlap(n, percent))
    most = min(MAX_MATCHES, n - base)
    reach = np.cumsum(np.maximum(freq[order[:base + most]].astype(np.float64) - 1, 0))
    # reach[base + m - 1] postings are read; at most that many / m documents
    # can match m times.
    m = np.arange(1, most + 1)
    cost = reach[base:base + most] * (1 + VERIFY_COST / m)
    best = int(np.argmin(cost)) + 1
    return s[order[:base + best]], best


def _postings(docs: DataFrame, counts, size: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for b in batches:
            tokens, n, m, k, head = [], [], [], [], []
            for t in b.column("t"):
                s = shingles(t.as_py(), size)
                p, best = _prefix(s, table, percent) if len(s) else (s, 1)
                tokens.append(p.view(np.int64))
                k.append(len(p))
                n.append(len(s))
                m.append(best)
                head.append(len(s) - index_overlap(len(s), percent) + best if len(s) else 0)
            ends = np.concatenate(([0], np.cumsum(k))).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), pa.array(n, pa.int32()), pa.array(m, pa.int32()),
                 pa.array(head, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                ["i", "n", "m", "head", "tokens"])

    return docs.mapInArrow(run, "i bigint, n int, m int, head int, tokens array<bigint>")


class _Sets:
    """Sets of the texts at hand; one text of a list is often asked for again."""

    def __init__(self, size: int, keep: int = 64):
        self.size, self.keep, self.held = size, keep, {}

    def get(self, text: str) -> np.ndarray:
        s = self.held.get(text)
        if s is None:
            if len(self.held) >= self.keep:
                self.held.clear()
            s = self.held[text] = shingles(text, self.size)
        return s


def _verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold. Texts are joined, not
    sets: compressed, they are less than half as large."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(size)
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("ta"), batch.column("tb")):
                p, q = sets.get(x.as_py()), sets.get(y.as_py())
                both = len(p) + len(q) - len(np.union1d(p, q))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    pairs = staged(pairs.select("a", "b"), f"{name}-pairs")
    both = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
            .select("a", "b", "ta", "tb"))
    return staged(both.mapInArrow(run, "a bigint, b bigint"), name)


def _attach(postings: DataFrame, comp: DataFrame) -> DataFrame:
    """Postings with the component of each document (itself if it has none)."""
    return (postings.drop("c").join(comp.withColumnsRenamed({"node": "i", "component": "c"}), "i", "left")
            .withColumn("c", F.coalesce("c", "i")))


def _open_lists(postings: DataFrame, name: str) -> DataFrame:
    """Postings of the shingles in some index part whose documents lie in
    several components."""
    mixed = staged(postings.groupBy("t").agg(F.min("c").alias("c0"), F.max("c").alias("c1"),
                                             F.bool_or("idx").alias("idx"))
                   .filter("idx AND c0 != c1").select("t"), f"{name}-tokens")
    return staged(postings.join(mixed, "t", "left_semi"), name)


def _fits(n1, n2, percent: int):
    """Whether two set sizes allow the threshold at all."""
    return F.least(n1, n2).cast("bigint") * 100 >= F.greatest(n1, n2).cast("bigint") * percent


def _star_pairs(postings: DataFrame, salt: int, percent: int) -> DataFrame:
    """Each posting against one member of its list: never more than postings.
    The first round takes one order for all lists, so a group of copies meets
    in one member; later ones take an order for each list, which gives every
    document as many partners as it has lists."""
    order = F.xxhash64(F.lit(salt), "i") if salt == 0 else F.xxhash64(F.lit(salt), "t", "i")
    hub = staged(postings.filter("idx").groupBy("t").agg(F.min(F.struct(
        order.alias("r"), F.col("i").alias("hi"), F.col("n").alias("hn"),
        F.col("c").alias("hc"))).alias("h")), "hubs")
    return (postings.join(hub, "t")
            .filter((F.col("c") != F.col("h.hc")) & _fits(F.col("n"), F.col("h.hn"), percent))
            .select(F.least("i", "h.hi").alias("a"), F.greatest("i", "h.hi").alias("b")).distinct())


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Pairwise intersection sizes, by a membership matrix of bounded width."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[token] > 1
    column = np.cumsum(count > 1) - 1
    token, owner = column[token[shared]], owner[shared]
    by_token = np.argsort(token, kind="stable")
    token, owner = token[by_token], owner[by_token]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, MATRIX_COLUMNS):
        a, b = np.searchsorted(token, [low, low + MATRIX_COLUMNS])
        m = np.zeros((len(sets), MATRIX_COLUMNS), np.float32)
        m[owner[a:b], token[a:b] - low] = 1
        out += m @ m.T
    return out


def _hot_links(postings: DataFrame, hot: DataFrame, texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(clusters, links): documents that meet in hot lists, directly or through
    others, and the exact links within each cluster across components."""
    met = postings.join(hot, "t", "left_semi").select("t", "i", "c")
    hub = staged(met.groupBy("t").agg(F.min("i").alias("hub")), "hot-hubs")
    clusters = staged(connected_components(met.join(hub, "t").select("i", "hub"), "i", "hub")
                      .withColumnsRenamed({"node": "i", "component": "g"}), "hot-clusters")
    rows = (clusters.join(postings.select("i", "c").distinct(), "i").join(texts, "i")
            .select("g", "i", "c", "text"))
    unit = ["g", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in units(batches, unit):
            found = []
            for rows in groups:
                held = [shingles(r["text"], size) for r in rows]
                n = np.array([len(s) for s in held])
                both = _intersections(held)
                c = np.array([r["c"] for r in rows])
                side = np.array([r["side"] for r in rows])
                links = 100 * both >= percent * (n[:, None] + n[None, :] - both)
                links &= c[:, None] != c[None, :]
                if side.any():
                    links &= side[:, None] != side[None, :]
                found += forest(links, np.array([r["i"] for r in rows]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

    links = block_pairs(rows, ["g"], "i", BLOCK).mapInArrow(run, "a bigint, b bigint")
    return clusters, staged(links, "hot-links")


def _cross_pairs(postings: DataFrame, hot: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Pairs across components and clusters that share as many prefix shingles
    as the smaller requirement of the two asks for. Documents of two clusters
    share no hot shingle, so the counts here are complete."""
    postings = (postings.join(hot, "t", "left_anti").join(clusters, "i", "left"))
    cols = ["i", "n", "m", "c", "g"]
    x = postings.filter("idx").select("t", F.col("rest_idx").alias("restx"),
                                      *[F.col(c).alias(f"{c}x") for c in cols])
    y = postings.select("t", F.col("tail").alias("resty"), *[F.col(c).alias(f"{c}y") for c in cols])
    smaller = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("ix") < F.col("iy")))
    met = x.join(y, "t").filter(smaller & (F.col("cx") != F.col("cy"))
                                & (F.coalesce("gx", "ix") != F.coalesce("gy", "iy"))
                                & _fits(F.col("nx"), F.col("ny"), percent))
    counted = met.groupBy("ix", "iy").agg(
        F.count("*").alias("k"), *[F.first(c).alias(c) for c in ("nx", "ny", "mx", "my", "restx", "resty")])
    # What is not matched in the prefixes can only be matched beyond them.
    beyond = F.greatest("restx", "resty")
    reach = (100 + percent) * (F.col("k") + beyond) >= percent * (F.col("nx") + F.col("ny")).cast("bigint")
    return (counted.filter((F.col("k") >= F.least("mx", "my")) & reach)
            .select(F.col("ix").alias("a"), F.col("iy").alias("b")))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    - NULL or empty text, or one without words: n_shingles 0, linked with nothing.
    - Fewer than ``size`` words: the whole sequence is the one shingle.
    - Rows of one id and text are one node. Different texts under one id are one
      node too, described by the largest of their sets: keep ids unique to be exact.
    - NULL id: n_shingles is given, component_id is NULL, and it links nothing.
    - Other columns are not carried; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    spark = docs.sparkSession
    out_type = docs.schema[id_col].dataType
    with arrow_batch(spark, 500):
        scanned = staged(_scan(rows, size), "shingle-scan")
        print_ = scanned.filter("counts IS NULL")
        reps = staged(print_.filter("n > 0 AND i IS NOT NULL").groupBy("h1", "h2")
                      .agg(F.min("i").alias("rep")), "set-representatives")
        counts = spark.sparkContext.broadcast(_merge_counts(scanned))
        # Copies leave here.
        prefixes = staged(
            _postings(rows.filter("i IS NOT NULL"), counts, size, percent).filter("n > 0")
            .join(reps.select(F.col("rep").alias("i")).distinct(), "i", "left_semi"), "prefixes")
        one = (prefixes.select("i", "head", F.posexplode("tokens").alias("p", "t"))
               .select("i", "t", (F.col("p") < F.col("head")).alias("idx")))
        # Most shingles lie in one prefix only; just their counts are shuffled.
        shared = staged(one.groupBy("t").agg(F.count("*").alias("k"), F.bool_or("idx").alias("idx"))
                        .filter("idx AND k > 1").select("t"), "shared-tokens")
        # rest, tail: shingles beyond the index part, beyond the prefix.
        about = prefixes.select("i", "n", "m", (F.col("n") - F.col("head")).alias("rest_idx"),
                                (F.col("n") - F.size("tokens")).alias("tail")).groupBy("i").agg(
            *[F.max(c).alias(c) for c in ("n", "m", "rest_idx", "tail")])
        listed = staged(one.join(shared, "t", "left_semi"), "listed")
        postings = staged(listed.join(about, "i").withColumn("c", F.col("i")), "postings")
        discard(prefixes)
        texts = staged(rows.join(postings.select("i").distinct(), "i", "left_semi")
                       .select("i", F.col("t").alias("text")), "candidate-texts")
        links = None
        for salt in range(STAR_ROUNDS):
            found = _verify(_star_pairs(postings, salt, percent), texts, size, percent, f"star-links{salt}")
            links = found if links is None else links.union(found)
            comp = connected_components(links, "a", "b")
            postings = _open_lists(_attach(postings, comp), f"open{salt}")
        hot = staged(postings.filter("idx").groupBy("t").count()
                     .filter(F.col("count") > HOT_LIST).select("t"), "hot-tokens")
        clusters, in_hot = _hot_links(postings, hot, texts, size, percent)
        pairs = _cross_pairs(postings, hot, clusters, percent)
        links = links.union(in_hot).union(_verify(pairs, texts, size, percent, "cross-links"))
        members = print_.filter("n > 0 AND i IS NOT NULL").join(reps, ["h1", "h2"])
        same = members.filter("i != rep").select(F.col("i").alias("a"), F.col("rep").alias("b"))
        comp = staged(connected_components(links.union(same), "a", "b"), "doc-components")
    return (print_.join(comp.withColumnRenamed("node", "i"), "i", "left")
            .select(F.col("i").cast(out_type).alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "i").alias("component_id")))


def digest(docs: DataFrame) -> DataFrame:
    return link_documents(docs.select("doc_id", "text"))


ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT row, doc_id, unnest(list_distinct(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
           ELSE [array_to_string(w[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {SHINGLE - 2})] END)) AS shingle
  FROM w),
n AS (SELECT row, doc_id, count(*) AS n FROM s GROUP BY row, doc_id),
met AS (
  SELECT a.row AS x, b.row AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.row <> b.row
  GROUP BY a.row, b.row),
links AS (
  SELECT DISTINCT nx.doc_id AS a, ny.doc_id AS b FROM met JOIN n nx ON nx.row = x JOIN n ny ON ny.row = y
  WHERE 100 * k >= {PERCENT} * (nx.n + ny.n - k)),
reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(w.doc_id, least_of.b), w.doc_id) AS component_id
FROM w LEFT JOIN n USING (row) LEFT JOIN least_of ON least_of.a = w.doc_id
"""
