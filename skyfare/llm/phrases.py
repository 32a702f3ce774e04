"""Phrase collocation mining with Rabin-Karp fingerprints.

Every n-gram is fingerprinted by prefix polynomials in numpy: one over the
bytes gives each word's hash as a difference, one over the word hashes gives
each n-gram's. A shuffle adds up the fingerprints. For the frequent ones a
second pass keeps pointers to the first and the last text and the least and
the greatest of a second hash; only they are read back from the texts that the
pointers name. Two pointers with different words, or two different second
hashes, betray a collision, and the occurrences of such a fingerprint are
counted again by their words.

Sizes are counted in turn: an n-gram can be frequent only if both (n-1)-grams
in it are, so the frequent ones of one size filter the next. The filter is a
bitmap of bounded size with false positives and no false negatives; it saves
shuffle and never changes a count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfare.llm.common import arrow_batch, discard, staged

MAX_WORDS = 3
MIN_COUNT = 10
ABSORB_PERCENT = 50
TOP = 2000
UNKNOWN = "und"

# Words hashed at once, n-grams added up in a task before they are passed on,
# rows to an Arrow batch in and out, and bytes of text taken from one at a time.
BLOCK_WORDS = 200_000
BUFFER_GRAMS = 3_000_000
BATCH_ROWS, BATCH_OUT = 250, 1 << 16
SLICE_BYTES = 4 << 20
# Bits of the filter to a frequent n-gram, and its greatest size (16 MB).
BITS_PER_GRAM = 32
MAX_FILTER_BITS = 1 << 27
# Scores lie between 0 and 1,000,000. They are ranked in bands: each score below
# this one by itself, then so many together (1,999 bands at most).
BAND = 1000
# A band is ranked in so many parts before the last ranking.
RANK_PARTS = 64

# A-Z lower-cased, and what ends a piece made a newline.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
_GAP = np.isin(np.arange(256), (9, 10, 32))
# Odd, so that they have an inverse modulo 2**64: bases over bytes and over words,
# one of each for the fingerprint and for the second hash.
_BASES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass(frozen=True)
class Hashing:
    """Bits of a fingerprint and words hashed at once. Neither changes a
    result: fewer bits serve only to provoke collisions, and phrases may lie
    across the border of two blocks."""

    bits: int = 64
    block: int = BLOCK_WORDS


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, grown when needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = (np.concatenate((np.ones(1, np.uint64), np.cumprod(
                np.full(n - 1, b, np.uint64)))) for b in (self.base, self.inverse))


class _Hashes:
    """Polynomial hashes of ``values[start:end]``, wherever it lies."""

    def __init__(self, values: np.ndarray, powers: _Powers):
        powers.reach(len(values) + 1)
        self.down = powers.down
        self.prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers.up[:len(values)], out=self.prefix[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.prefix[ends] - self.prefix[starts]) * self.down[starts]


class _Words:
    """The words of one Arrow batch, hashed block by block."""

    def __init__(self, texts: pa.Array, seeds: np.ndarray, powers, how: Hashing):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        self.raw = (bytes(memoryview(data)[offsets[0]:offsets[-1]]) if data else b"").translate(_FOLD)
        b = np.frombuffer(self.raw, np.uint8)
        gap = _GAP[b]
        before = np.concatenate((np.ones(1, bool), gap[:-1]))
        # Each text ends with a newline, so every word has an end.
        self.starts = np.flatnonzero(~gap & before)
        self.ends = np.flatnonzero(gap & ~before)
        self.piece = np.searchsorted(np.flatnonzero(b == 10), self.starts)
        self.doc = np.searchsorted(offsets - offsets[0], self.starts, "right") - 1
        self.bytes, self.seeds, self.powers = b, seeds, powers
        self.mask = None if how.bits >= 64 else np.uint64((1 << how.bits) - 1)
        self.block = how.block

    def blocks(self, sizes: tuple[int, ...]) -> Iterator[tuple[int, dict, Callable]]:
        """For each block its first word, {size: (first words, fingerprints)} of
        the n-grams that start in it and lie in one piece, and a function that
        gives second hashes of (first words, size)."""
        top, n = max(sizes), len(self.starts)
        for i in range(0, n, self.block):
            j = min(i + self.block + top - 1, n)
            at = self.starts[i]
            values = self.bytes[at:self.ends[j - 1]].astype(np.uint64) + np.uint64(1)

            def grams(which: int, i=i, j=j, at=at, values=values) -> _Hashes:
                by_byte, by_word = self.powers[which]
                words = _Hashes(values, by_byte).of(self.starts[i:j] - at, self.ends[i:j] - at)
                return _Hashes(_mix(words), by_word)

            def hashed(hashes: _Hashes, first: np.ndarray, m: int, i=i) -> np.ndarray:
                return _mix(hashes.of(first - i, first - i + m) ^ self.seeds[self.doc[first]])

            out, hashes = {}, grams(0)
            for m in sizes:
                first = np.arange(i, max(min(i + self.block, j - m + 1), i))
                first = first[self.piece[first] == self.piece[first + m - 1]]
                fp = hashed(hashes, first, m)
                out[m] = first, fp if self.mask is None else _mix(fp & self.mask)
            second = []

            def check(first: np.ndarray, m: int, grams=grams, hashed=hashed, second=second) -> np.ndarray:
                if not second:
                    second.append(grams(1))
                return hashed(second[0], first, m)

            yield i, out, check

    def text(self, first: int, m: int) -> str:
        return b" ".join(self.raw[self.starts[k]:self.ends[k]] for k in range(first, first + m)).decode()


def _batches(batches: Iterator[pa.RecordBatch], how: Hashing) -> Iterator[tuple[pa.RecordBatch, _Words]]:
    powers = [(_Powers(a), _Powers(b)) for a, b in _BASES]
    for whole in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(whole.column("text")), 0).to_numpy())
        at = 0
        while at < len(whole):
            # As many texts as fit into a slice, and one at least.
            fit = np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")
            batch = whole.slice(at, max(int(fit) - at, 1))
            at += len(batch)
            seeds = batch.column("seed").to_numpy().view(np.uint64)
            yield batch, _Words(batch.column("text"), seeds, powers, how)


class _Filter:
    """A bitmap of frequent fingerprints: two probes each, sized by their
    number up to ``MAX_FILTER_BITS``. The driver sees the bitmap, at most
    16 MB at any input."""

    def __init__(self, frequent: DataFrame):
        spark = frequent.sparkSession
        wanted = max(frequent.count() * BITS_PER_GRAM, 1 << 16)
        self.log = min(wanted - 1, MAX_FILTER_BITS - 1).bit_length()
        probes = F.array(F.col("fp").bitwiseAND(F.lit((1 << self.log) - 1)) + 1,
                         F.shiftrightunsigned("fp", 64 - self.log) + 1)
        at = frequent.select(F.explode(probes).alias("at"))
        parts = (at.groupBy(F.bitmap_bucket_number("at").alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())
        size = max(len(r["bits"]) for r in parts) if parts else 1
        bitmap = bytearray(max(1 << (self.log - 3), size))
        for r in parts:
            bitmap[(r["bucket"] - 1) * size:r["bucket"] * size] = r["bits"]
        self.shared = spark.sparkContext.broadcast(bytes(bitmap))

    def holds(self, fp: np.ndarray) -> np.ndarray:
        bitmap = np.frombuffer(self.shared.value, np.uint8)
        out = np.ones(len(fp), bool)
        for at in (fp & np.uint64((1 << self.log) - 1), fp >> np.uint64(64 - self.log)):
            out &= ((bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1) == 1
        return out

    def free(self) -> None:
        self.shared.unpersist()


def _begins(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins."""
    return np.flatnonzero(np.concatenate((np.ones(1, bool), ordered[1:] != ordered[:-1])))


def _added(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    fp = np.sort(np.concatenate(parts))
    at = _begins(fp)
    yield from _out({"fp": fp[at].view(np.int64), "n": np.diff(np.append(at, len(fp)))})


def _pointed(size: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    fp, check, row = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(fp)
    fp, check, row = fp[order], check[order].view(np.int64), row[order]
    at = _begins(fp)
    yield from _out({"size": np.full(len(at), size, np.int32), "fp": fp[at].view(np.int64),
                     "c0": np.minimum.reduceat(check, at), "c1": np.maximum.reduceat(check, at),
                     "r0": np.minimum.reduceat(row, at), "r1": np.maximum.reduceat(row, at)})


def _out(cols: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in cols.values()], list(cols))
    for at in range(0, len(batch), BATCH_OUT):
        yield batch.slice(at, BATCH_OUT)


def _count(texts: DataFrame, m: int, below: _Filter | None, how: Hashing) -> DataFrame:
    """fp, n of the n-grams of ``m`` words: added up in each task, then by shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, words in _batches(batches, how):
            for i, found, _ in words.blocks((m,) if below is None else (m - 1, m)):
                first, fp = found[m]
                if below is not None:
                    sub, sub_fp = found[m - 1]
                    # Unknown: the sub-gram after a block's last one; it is kept.
                    good = np.ones(how.block + 1, bool)
                    good[sub - i] = below.holds(sub_fp)
                    fp = fp[good[first - i] & good[first - i + 1]]
                held.append(fp)
                n += len(fp)
                if n >= BUFFER_GRAMS:
                    yield from _added(held)
                    held, n = [], 0
        if n:
            yield from _added(held)

    return (texts.select("seed", "text").mapInArrow(run, "fp bigint, n bigint")
            .groupBy("fp").agg(F.sum("n").alias("n")))


def _locate(texts: DataFrame, among: dict[int, _Filter], how: Hashing) -> DataFrame:
    """size, fp, c0, c1 (least and greatest second hash), r0, r1 (first and
    last row) of the n-grams that pass the filter of their size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = {m: [] for m in among}, 0
        for batch, words in _batches(batches, how):
            rows = batch.column("row").to_numpy()
            for _, found, check in words.blocks(tuple(among)):
                for m, (first, fp) in found.items():
                    hit = among[m].holds(fp)
                    if hit.any():
                        first = first[hit]
                        held[m].append((fp[hit], check(first, m), rows[words.doc[first]]))
                        n += len(first)
                if n >= BUFFER_GRAMS:
                    for m in among:
                        if held[m]:
                            yield from _pointed(m, held[m])
                    held, n = {m: [] for m in among}, 0
        for m in among:
            if held[m]:
                yield from _pointed(m, held[m])

    found = texts.select("row", "seed", "text").mapInArrow(
        run, "size int, fp bigint, c0 bigint, c1 bigint, r0 bigint, r1 bigint")
    return found.groupBy("size", "fp").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"),
                                           F.min("r0").alias("r0"), F.max("r1").alias("r1"))


def _read_back(texts: DataFrame, points: DataFrame, sizes: tuple[int, ...], how: Hashing) -> DataFrame:
    """size, fp, lang, phrase: the words of each fingerprint in the rows it
    points to (at most two rows; equal readings are given once)."""
    wanted = (points.select("size", "fp", F.explode(F.array_distinct(F.array("r0", "r1"))).alias("row"))
              .groupBy("row").agg(*[F.collect_list(F.when(F.col("size") == m, F.col("fp"))).alias(f"w{m}")
                                    for m in sizes]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _batches(batches, how):
            salt = _mix(np.arange(1, len(batch) + 1, dtype=np.uint64))
            keys = {}
            for m in sizes:
                want = batch.column(f"w{m}")
                # (row, fingerprint) as one number, to look all of them up at once.
                keys[m] = np.sort(want.flatten().to_numpy().view(np.uint64)
                                  ^ np.repeat(salt, np.diff(want.offsets.to_numpy())))
            done, out = set(), []
            for _, found, _ in words.blocks(sizes):
                for m, (first, fp) in found.items():
                    if not len(keys[m]):
                        continue
                    key = fp ^ salt[words.doc[first]]
                    at = np.minimum(np.searchsorted(keys[m], key), len(keys[m]) - 1)
                    hit = np.flatnonzero(keys[m][at] == key)
                    doc, fp, first = words.doc[first[hit]], fp[hit], first[hit]
                    order = np.lexsort((fp, doc))
                    new = np.ones(len(order), bool)
                    new[1:] = (np.diff(doc[order]) != 0) | (fp[order][1:] != fp[order][:-1])
                    for k in order[new]:
                        if (place := (m, doc[k], fp[k])) not in done:
                            done.add(place)
                            out.append((*place, words.text(first[k], m)))
            fps = np.array([o[2] for o in out], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array(fps),
                 batch.column("lang").take(pa.array([o[1] for o in out], pa.int64())),
                 pa.array([o[3] for o in out], pa.string())], ["size", "fp", "lang", "phrase"])

    return (texts.join(wanted, "row").select("seed", "lang", "text", *[f"w{m}" for m in sizes])
            .mapInArrow(run, "size int, fp bigint, lang string, phrase string").distinct())


def _by_words(texts: DataFrame, collided: DataFrame, m: int, how: Hashing) -> DataFrame:
    """lang, phrase, n of all n-grams with a collided fingerprint, counted by
    their words. Each task adds up its own before the shuffle."""
    if not collided.head(1):
        return None
    among = _Filter(collided)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _batches(batches, how):
            langs = batch.column("lang").to_pylist()
            counts: dict[tuple, int] = {}
            for _, found, _ in words.blocks((m,)):
                first, fp = found[m]
                hit = among.holds(fp)
                for k, f in zip(first[hit].tolist(), fp[hit].view(np.int64).tolist()):
                    key = f, langs[words.doc[k]], words.text(k, m)
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.int64()), pa.array([k[1] for k in counts], pa.string()),
                 pa.array([k[2] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["fp", "lang", "phrase", "n"])

    found = texts.select("seed", "lang", "text").mapInArrow(run, "fp bigint, lang string, phrase string, n bigint")
    return (found.join(collided.select("fp"), "fp", "left_semi")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")))


def _stage_texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """row, lang, seed, text (newline added), n_words: written once, so that a
    row number points to the same text in every pass."""
    text = F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n"))
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), lang.alias("lang"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = []
            for t in batch.column("text"):
                gap = _GAP[np.frombuffer(t.as_buffer().to_pybytes().translate(_FOLD), np.uint8)]
                n.append(int(np.count_nonzero(~gap[:-1] & gap[1:])))
            yield batch.append_column("n_words", pa.array(n, pa.int64()))

    return staged(rows.mapInArrow(run, "row bigint, lang string, text string, n_words bigint")
                  .select("row", "lang", F.xxhash64("lang").alias("seed"), "text", "n_words"), "phrase-texts")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT, how: Hashing = Hashing()) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, phrase, size, n of every phrase of 1 to
    ``max_words`` words found ``min_count`` times or more, and lang, n of all
    words. Exact whatever the fingerprints."""
    spark = docs.sparkSession
    with arrow_batch(spark, BATCH_ROWS):
        texts = _stage_texts(docs, text_col, lang_col)
        totals = staged(texts.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")
        sizes, among, frequent = tuple(range(1, max_words + 1)), {}, None
        spent = [texts]
        for m in sizes:
            count = _count(texts, m, among.get(m - 1), how).filter(F.col("n") >= min_count)
            spent.append(staged(count, f"phrase-counts{m}"))
            among[m] = _Filter(spent[-1])
            sized = spent[-1].withColumn("size", F.lit(m))
            frequent = sized if frequent is None else frequent.union(sized)
        points = staged(_locate(texts, among, how).join(frequent, ["size", "fp"]), "phrase-points")
        read = _read_back(texts, points, sizes, how)
        seen = read.groupBy("size", "fp").agg(F.count("*").alias("readings"), F.first("lang").alias("lang"),
                                              F.first("phrase").alias("phrase"))
        bad = (F.col("c0") != F.col("c1")) | (F.col("readings") > 1)
        judged = staged(points.join(seen, ["size", "fp"]).select(
            "lang", "phrase", "size", "n", "fp", bad.alias("bad")), "phrase-judged")
        phrases = judged.filter(~F.col("bad")).drop("fp", "bad")
        for m in sizes:
            again = _by_words(texts, judged.filter(F.col("bad") & (F.col("size") == m)).select("fp"), m, how)
            if again is not None:
                phrases = phrases.union(again.filter(F.col("n") >= min_count)
                                        .select("lang", "phrase", F.lit(m).alias("size"), "n"))
        phrases = staged(phrases, "phrases")
        for t in [*spent, points, judged]:
            discard(t)
        for f in among.values():
            f.free()
    return phrases, totals


# floor(1000000 * a * a / (l * r)), exact for counts below 10**14.
SCORE = ("CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(14,0)) * CAST(a AS DECIMAL(14,0))) "
         "DIV (CAST(l AS DECIMAL(14,0)) * CAST(r AS DECIMAL(14,0)))")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, absorb: int = ABSORB_PERCENT, top: int = TOP,
                 how: Hashing = Hashing()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases a language.

    - A NULL or empty text has no words; NULL languages count as ``und``,
      together with rows that say ``und``.
    - Repeated rows count each time. Other input columns are not read, so
      their names cannot clash. An empty table has no phrases.
    - Equal scores go by count, then by the phrase in UTF-8 byte order, so
      every rank is defined.

    The driver sees the bitmap of ``_Filter`` and counts, no n-grams. A very
    common phrase is one row a task in the shuffle; very common words are hot
    keys only in the joins of candidates, which are split by skew.
    """
    phrases, totals = frequent_phrases(docs, text_col, lang_col, max_words, min_count, how)
    words = F.split("phrase", " ", -1)
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    candidates = phrases.filter("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w"))
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"),
                    part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")))
    known = phrases.select("lang", "phrase", "n")
    scored = (cuts.join(known.withColumnsRenamed({"phrase": "head", "n": "l"}), ["lang", "head"])
              .join(known.withColumnsRenamed({"phrase": "rest", "n": "r"}), ["lang", "rest"])
              .withColumn("score", F.expr(SCORE)))
    best = (scored.groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
            .select("lang", "phrase", "a", "b.l", "b.r", "b.score"))
    # Every shorter candidate inside a longer one, with the longer one's count.
    inner = (candidates.filter("size > 2")
             .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
             .select("lang", part(F.col("i"), F.col("m")).alias("phrase"), F.col("a").alias("longer"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    left = (best.join(inner, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("longer") < absorb * F.col("a"), F.lit(True))).drop("longer"))
    return _ranked(left, top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """``rows`` with ``rank``, the first ``top`` a language. Bands of scores are
    counted first; a row's rank is what lies in better bands, plus its place in
    its own. Bands that start past ``top`` are not ranked at all, and no task
    sorts a language: at most 1,999 counts, or RANK_PARTS x ``top`` rows of one band."""
    rows = staged(rows.withColumn("band", F.expr(
        f"CASE WHEN score < {BAND} THEN score ELSE {BAND - 1} + score DIV {BAND} END")), "phrase-scores")
    better = Window.partitionBy("lang").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bands = (rows.groupBy("lang", "band").agg(F.count("*").alias("in_band"))
             .withColumn("before", F.coalesce(F.sum("in_band").over(better), F.lit(0)))
             .filter(F.col("before") < top).drop("in_band"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    dealt = (rows.join(bands, ["lang", "band"])
             .withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))))
    short = (dealt.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "band", "part").orderBy(*order))).filter(F.col("rank") <= top))
    return (short.withColumn("rank", F.col("before") + F.row_number().over(
        Window.partitionBy("lang", "band").orderBy(*order))).filter(F.col("rank") <= top))


def digest(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("text", "lang"))


ORACLE_SQL = rf"""
WITH t AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, row_number() OVER () AS row,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
p AS (
  SELECT lang, row, generate_subscripts(ps, 1) AS piece, unnest(ps) AS words
  FROM (SELECT lang, row, string_split_regex(text, '[.,;:!?\x0A-\x0D]') AS ps FROM t)),
w AS (
  SELECT lang, row, piece, generate_subscripts(ws, 1) AS i, unnest(ws) AS w
  FROM (SELECT lang, row, piece, regexp_extract_all(words, '[^\x20\x09]+') AS ws FROM p)),
g AS (
  SELECT lang, w AS w1, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3
  FROM w WINDOW o AS (PARTITION BY row, piece ORDER BY i)),
n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS c FROM g GROUP BY lang, w1),
f2 AS (SELECT lang, w1, w2, count(*) AS c FROM g WHERE w2 IS NOT NULL GROUP BY lang, w1, w2),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS c FROM g WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3
       HAVING count(*) >= {MIN_COUNT}),
i AS (SELECT lang, w1, w2, max(c) AS c
      FROM (SELECT lang, w1, w2, c FROM f3 UNION ALL SELECT lang, w2, w3, c FROM f3) x GROUP BY lang, w1, w2),
cut AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.c AS a, 1 AS k, l.c AS l, r.c AS r,
         i.c AS longer
  FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.w1 = f2.w1
          JOIN f1 r ON r.lang = f2.lang AND r.w1 = f2.w2
          LEFT JOIN i ON i.lang = f2.lang AND i.w1 = f2.w1 AND i.w2 = f2.w2
  WHERE f2.c >= {MIN_COUNT}
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.c, 1, l.c, r.c, NULL
  FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.w1 = f3.w1
          JOIN f2 r ON r.lang = f3.lang AND r.w1 = f3.w2 AND r.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.c, 2, l.c, r.c, NULL
  FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.w1 = f3.w1 AND l.w2 = f3.w2
          JOIN f1 r ON r.lang = f3.lang AND r.w1 = f3.w3),
s AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cut
  WHERE longer IS NULL OR 100 * longer < {ABSORB_PERCENT} * a),
b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
