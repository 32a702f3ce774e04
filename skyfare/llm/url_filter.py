"""URL filter: a weighted vocabulary counted by an Aho-Corasick automaton.

Host rules come first (longest rule wins). For the rest, one pass of the
automaton over the lower-cased URL finds every term at once; a hit counts only
between boundaries. One strict term blocks the URL, and so do several distinct
soft terms whose weights add up to the limit.

The vocabulary is a table of (term, kind, weight): the default below, or any
DataFrame of these columns, such as one read from a file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from skyfare.llm.common import ascii_lower, unwrapped, wrapped

# The rules of the contract, and the default vocabulary by weight
# (soft terms that also stand in clean URLs weigh less).
RULES = (("net/", "block"), ("example.net/en/", "allow"),
         ("example.com/de/", "block"), ("org/fr/", "allow"))
STRICT = ("spam", "porn", "porno", "xxx", "casino", "casinos", "viagra", "cialis", "malware", "phishing", "warez",
          "keygen", "escort", "escorts", "milf", "hentai", "jackpot", "sportsbook", "payday", "botnet")
SOFT = {
    1.5: ("pills", "pharmacy", "betting", "bets", "poker", "roulette", "slots", "torrent", "crack", "cracked",
          "replica", "nude", "erotic", "webcam", "steroids", "forex", "crypto", "loan", "loans", "casting"),
    1.0: ("cheap", "free", "farm", "bonus", "adult", "bet", "click", "win", "winner", "deal", "deals", "hot",
          "lottery", "prize", "discount", "dating", "singles", "download", "serial", "miracle"),
    0.5: ("buy", "offer", "offers", "sale", "shop", "best", "cash", "money", "promo", "coupon", "weight", "diet",
          "credit", "debt", "trial", "instant", "online", "now"),
}
VOCABULARY = (*((t, "strict", 1.0) for t in STRICT), *((t, "soft", w) for w, ts in SOFT.items() for t in ts))
MIN_SOFT, MIN_WEIGHT = 2, 2.0
# The most terms a vocabulary may have: it is sent to every worker.
MAX_TERMS = 1_000_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end; empty if none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both NULL if none does.
    Rules of one length go by their text, so that a tie has one answer."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        h, slash, p = text.partition("/")
        fits = (((host == h) | host.endswith("." + h)) & F.startswith(path, F.lit(slash + p)))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


TERMS = StructType([StructField("term", StringType()), StructField("kind", StringType()),
                    StructField("weight", DoubleType())])


@dataclass(frozen=True)
class Vocabulary:
    """Terms by kind, each once; strict wins, then the greater weight."""

    terms: tuple[tuple[str, str, float], ...]

    @staticmethod
    def of(rows) -> Vocabulary:
        best: dict[str, tuple[str, float]] = {}
        for term, kind, weight in rows:
            term = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term or "")
            if kind not in ("strict", "soft"):
                raise ValueError(f"unknown kind {kind!r} of term {term!r}")
            if term:
                best[term] = max(best.get(term, ("", 0.0)), (kind, float(1.0 if weight is None else weight)),
                                 key=lambda b: (b[0] == "strict", b[1]))
        return Vocabulary(tuple((t, k, w) for t, (k, w) in sorted(best.items())))

    @staticmethod
    def read(terms: DataFrame) -> Vocabulary:
        """A table of term, kind and weight (NULL: 1), of at most ``MAX_TERMS``
        rows: a vocabulary, not a corpus."""
        rows = terms.select("term", "kind", "weight").limit(MAX_TERMS + 1).collect()
        if len(rows) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} terms")
        return Vocabulary.of(rows)


@lru_cache(maxsize=4)
def automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    """Built once for each worker and vocabulary."""
    a = ahocorasick.Automaton()
    for term, kind, weight in vocabulary.terms:
        a.add_word(term, (term, kind, weight))
    if len(a):
        a.make_automaton()
    return a


def _inside(ch: str) -> bool:
    return "a" <= ch <= "z" or "0" <= ch <= "9"


def count_terms(a: ahocorasick.Automaton, url: str | None) -> tuple[int, int, float]:
    """(distinct strict, distinct soft, weight of the soft) terms that stand
    alone in ``url``: the characters next to a hit are neither a-z nor 0-9."""
    found: dict[str, tuple[str, float]] = {}
    if url and len(a):
        for end, (term, kind, weight) in a.iter(url):
            start = end - len(term)
            if (start < 0 or not _inside(url[start])) and (
                    end + 1 == len(url) or not _inside(url[end + 1])):
                found[term] = kind, weight
    soft = [w for k, w in found.values() if k == "soft"]
    return len(found) - len(soft), len(soft), sum(sorted(soft))


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES, terms: DataFrame | None = None,
               min_soft: int = MIN_SOFT, min_weight: float = MIN_WEIGHT) -> DataFrame:
    """``pages`` plus host, path, rule, n_strict, n_soft, soft_weight and verdict.

    A NULL URL or one without ``://`` has an empty host and path and fits no
    rule; terms are still counted in the whole URL (none in a NULL), however
    long. Columns named like an added one are replaced; all others come through,
    whatever their names. No shuffle: one pass over the rows.
    """
    added = ["host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight"]
    carry = [c for c in pages.columns if c.lower() not in added]
    vocabulary = Vocabulary.of(VOCABULARY) if terms is None else Vocabulary.read(terms)
    shared = pages.sparkSession.sparkContext.broadcast(vocabulary)
    counted = [StructField("n_strict", IntegerType()), StructField("n_soft", IntegerType()),
               StructField("soft_weight", DoubleType())]
    base = wrapped(pages, carry, url=url_col).withColumn("low", ascii_lower(F.col("url")))
    schema = StructType([*base.schema.fields, *counted])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(shared.value)
        for b in batches:
            hits = list(zip(*(count_terms(a, u) for u in b.column("low").to_pylist()))) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(hits[0], pa.int32()), pa.array(hits[1], pa.int32()),
                 pa.array(hits[2], pa.float64())], schema.fieldNames())

    bad = (F.col("n_strict") >= 1) | ((F.col("n_soft") >= min_soft) & (F.col("soft_weight") >= min_weight))
    rule, says = rule_columns(F.col("host"), F.col("path"), rules)
    judged = (base.mapInArrow(count, schema).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
              .withColumns({"rule": rule, "says": says})
              .withColumn("verdict", F.coalesce("says", F.when(bad, "block").otherwise("allow"))))
    return judged.select(*unwrapped(carry), *added)


def digest(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")


def _hits(terms, times: float | None = None) -> str:
    one = " + ".join(f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT" for t in terms)
    return one if times is None else f"{times}::DOUBLE * ({one})"


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, url, CASE WHEN position('://' IN url) > 0
                       THEN substr(url, position('://' IN url) + 3) END AS rest,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM pages),
h AS (
  SELECT page_id, low,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM p),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule,
    {_hits(STRICT)} AS n_strict, {" + ".join(_hits(ts) for ts in SOFT.values())} AS n_soft,
    {" + ".join(_hits(ts, w) for w, ts in SOFT.items())} AS soft_weight
  FROM h)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN n_strict >= 1 OR (n_soft >= {MIN_SOFT} AND soft_weight >= {MIN_WEIGHT}) THEN 'block'
            ELSE 'allow' END AS verdict,
       n_strict, n_soft, soft_weight
FROM r
"""
