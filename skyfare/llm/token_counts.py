"""Token counts by a shortcut for whole tokens.

Most pre-tokens of a text are vocabulary strings. Which of them the tokenizer
gives back as one token is proved once, before any text is read: the string
has to pass the pre-tokenizer in one piece, and its bytes, merged pair by pair
like any others, have to end as that token alone. A vocabulary string may fail
(it is then reached by other merges or by none), so membership alone proves
nothing. Pre-tokens on the proved list count one; only the rest are merged.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from skyfare.llm.bpe import LATIN_PATTERN, _byte_chars

LIMIT = 1024
# Merged pre-tokens whose counts a worker keeps, and the longest one kept.
CACHE_PIECES = 300_000
CACHE_CHARS = 40
# Texts above this many characters are cut into pre-tokens one by one, not listed.
LIST_CHARS = 1 << 20
# Every merged pre-token adds this to a sum, so one sum holds two counts.
MERGED = 1 << 40


class Merges:
    """Pre-tokenizer and merge table of one byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_chars()
        vocab = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        self.of_byte = [0] * 256
        self.strings: dict[bytes, int] = {}
        for text, i in vocab.items():
            if text in self.special:
                continue
            raw = bytes(to_byte[c] for c in text)
            self.strings[raw] = i
            if len(raw) == 1:
                self.of_byte[raw[0]] = i
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.latin = re.compile(LATIN_PATTERN)
        self.beyond_latin = re.compile("[^\u0000-ɏ]").search
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False)

    def pieces(self, text: str) -> Iterator[str]:
        """Pre-tokens of a text without special tokens."""
        if self.beyond_latin(text):
            return (text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text))
        if len(text) > LIST_CHARS:
            return (m.group() for m in self.latin.finditer(text))
        return iter(self.latin.findall(text))

    def merged(self, raw: bytes) -> list[int]:
        """Ids of one pre-token: the earliest merge first, at equal rank the
        leftmost. A heap holds the pairs; stale ones are skipped."""
        ids = [self.of_byte[b] for b in raw]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*hit, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (hit := self.merge.get((ids[i], ids[i + 1])))]
        # Entries sort by rank, and a rank has one result: so by place next.
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            hit = self.merge.get((ids[i], ids[j]))
            if hit:
                heapq.heappush(heap, (*hit, i, ids[i], ids[j]))

        while heap:
            _, out, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = out, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [i for i in ids if i >= 0]

    def prove(self) -> list[str]:
        """The vocabulary strings that encode alone as one token, their own."""
        proved = []
        for raw, i in self.strings.items():
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                continue        # part of a character: never a pre-token
            if self.specials and self.specials.search(text):
                continue
            if self.merged(raw) == [i] and list(self.pieces(text)) == [text]:
                proved.append(text)
        return proved


class _Counts(dict):
    """Tokens of a pre-token: proved ones are filled in, others merged when
    first met and kept while there is room."""

    def __init__(self, merges: Merges, proved: list[str]):
        super().__init__(dict.fromkeys(proved, 1))
        self.merges, self.proved = merges, proved

    def __missing__(self, piece: str) -> int:
        n = MERGED + len(self.merges.merged(piece.encode()))
        if len(piece) <= CACHE_CHARS:
            if len(self) >= len(self.proved) + CACHE_PIECES:
                self.clear()
                self.update(dict.fromkeys(self.proved, 1))
            self[piece] = n
        return n


class Counter:
    """Counts tokens of whole texts."""

    def __init__(self, path: str, proved: list[str] | None = None):
        self.merges = Merges(path)
        self.counts = _Counts(self.merges, self.merges.prove() if proved is None else proved)

    def count(self, text: str | None) -> tuple[int, int]:
        """(tokens, pre-tokens that had to be merged). A special token's string
        counts one wherever it stands; a NULL text has no tokens."""
        if not text:
            return 0, 0
        parts, special = [text], 0
        if self.merges.specials and self.merges.specials.search(text):
            special = len(self.merges.specials.findall(text))
            parts = self.merges.specials.split(text)
        look_up = self.counts.__getitem__
        total = sum(sum(map(look_up, self.merges.pieces(p))) for p in parts)
        merged, tokens = divmod(total, MERGED)
        return tokens + special, merged


def prove_whole_tokens(spark: SparkSession, path: str):
    """The proof, made once and shared with the workers: at most the
    vocabulary, whatever the corpus."""
    return spark.sparkContext.broadcast(Merges(path).prove())


_LOADED: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit, n_merged (pre-tokens off the list).

    - A NULL or empty text has no bytes and no tokens.
    - NULL ids and repeated rows are counted like any other row.
    - Other columns are not carried, so their names cannot clash. No rows in,
      no rows out.
    - A very long text is read pre-token by pre-token; a very long pre-token
      is merged with a heap, in n log n.

    One pass in place, no shuffle. The driver makes the proof and sees no text.
    """
    proved = prove_whole_tokens(docs.sparkSession, path)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = Counter(path, proved.value)
        count = _LOADED[path].count
        for b in batches:
            found = [count(t.as_py()) for t in b.column("t")]
            tokens = [n for n, _ in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), b.column("n"), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_()), pa.array([m for _, m in found], pa.int64())],
                [id_col, "n_bytes", "n_tokens", "over_limit", "n_merged"])

    n_bytes = F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long")
    return (docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"), n_bytes.alias("n"))
            .mapInArrow(run, f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean, "
                             "n_merged bigint"))


def digest(docs: DataFrame, path: str) -> DataFrame:
    return count_tokens(docs, path)
