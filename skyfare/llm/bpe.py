"""Byte-level BPE by backtracking.

A piece of text is covered with longest vocabulary matches found by an
Aho-Corasick automaton. A token is accepted only if it is compatible with the
one before, that is, if merging their joint bytes gives exactly this pair;
otherwise the next shorter match is tried, and without one the encoder steps
back. Positions found to be dead are marked, so each is left at most once and
the work is linear. Decoding reads token bytes through an offset table.

Ids are carried as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

# Distinct pieces (and token pairs) kept per worker in each of two
# generations, and the longest piece kept.
CACHE_PIECES = 300_000
CACHE_CHARS = 40

# The pre-tokenizer's pattern with its classes written out for
# texts up to U+024F. Later characters go to the library's own pre-tokenizer,
# whose Unicode tables are what the result has to agree with.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = "\t-\r \u0085 "
LATIN_PATTERN = (rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+"
                 rf"|[{_S}]+(?![^{_S}])|[{_S}]+")


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by character."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_chars()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        plain = {}
        for text, i in vocab.items():
            if text not in self.special:
                raw = bytes(to_byte[c] for c in text)
                self.bytes_of[i] = raw
                plain[raw] = i
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.id_of = plain
        # rank: when a pair merges; made_at: the rank that makes a token (-1: a byte).
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.left, self.right, self.made_at = [-1] * size, [-1] * size, [-1] * size
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            ia, ib = vocab[a], vocab[b]
            out = vocab[a + b]
            self.pair[ia, ib] = (rank, out)
            if self.made_at[out] < 0:
                self.left[out], self.right[out], self.made_at[out] = ia, ib, rank
        self.match = ahocorasick.Automaton()
        for raw, i in plain.items():
            self.match.add_word(raw.decode("latin-1"), (len(raw), i))
        self.match.make_automaton()
        self.shorter = [self._shorter(b) for b in self.bytes_of]
        self.pre = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.latin_pieces = re.compile(LATIN_PATTERN).findall
        self.beyond_latin = re.compile("[^\u0000-ɏ]").search
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.compatible: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.lengths, self.size_of = lengths, lengths.tolist()
        self.starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def _shorter(self, raw: bytes) -> int:
        """The longest token that is a proper prefix of ``raw``; -1 if none."""
        for n in range(len(raw) - 1, 0, -1):
            if (i := self.id_of.get(raw[:n])) is not None:
                return i
        return -1

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` together merge to exactly (a, b).

        Undo the merges of both tokens from the last to the first. The tokens
        that face each other across the border must never have had a merge
        earlier than the one that took either of them away; at equal rank the
        leftmost pair wins, which is inside ``a``, then the border, then ``b``.
        """
        key = a * len(self.bytes_of) + b
        if (known := self.compatible.get(key)) is not None:
            return known
        # until: border merges of a lower (rank, place) would have come first.
        # Places: 0 inside a, 1 the border, 2 inside b.
        until, ok = (1 << 60, 1), True
        while True:
            hit = self.pair.get((a, b))
            if hit is not None and (hit[0], 1) < until:
                ok = False
                break
            ra, rb = self.made_at[a], self.made_at[b]
            if ra < 0 and rb < 0:
                break
            # Undo the later of the two; at equal rank b's merge came second.
            if ra > rb:
                until, a = (ra, 0), self.right[a]
            else:
                until, b = (rb, 2), self.left[b]
        if len(self.compatible) > CACHE_PIECES:
            self.compatible.clear()
        self.compatible[key] = ok
        return ok

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.id_of.get(raw)
        if whole is not None and (self.left[whole] >= 0 or len(raw) == 1):
            return [whole]
        n = len(raw)
        longest = [-1] * n
        size_at = [0] * n
        for end, (size, i) in self.match.iter(raw.decode("latin-1")):
            start = end - size + 1
            if size > size_at[start]:
                size_at[start], longest[start] = size, i
        size_of, shorter, known, base = self.size_of, self.shorter, self.compatible, len(self.bytes_of)
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        pos, token = 0, longest[0]
        while pos < n:
            last = out[-1] if out else -1
            while token >= 0:
                end = pos + size_of[token]
                if alive[end]:
                    if last < 0:
                        break
                    ok = known.get(last * base + token)
                    if ok or (ok is None and self._compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos = end
                token = longest[pos] if pos < n else -1
            else:
                # Nothing fits here after ``last``: this position is dead.
                alive[pos] = 0
                last = out.pop()
                pos -= size_of[last]
                token = shorter[last]
        return out

    def _piece(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            found = self.encode_piece(piece.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_PIECES:
                self.cache, self.older = {}, self.cache
            self.cache[piece] = ids
        return ids

    def _pieces(self, text: str) -> list[str]:
        if self.beyond_latin(text):
            return [text[a:b] for _, (a, b) in self.pre.pre_tokenize_str(text)]
        return self.latin_pieces(text)

    def _plain(self, text: str) -> bytes:
        out, make = [], self._piece
        for p in self._pieces(text):
            out.append(self.cache.get(p) or make(p))
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; NULL is empty."""
        if not text:
            return b""
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out.append(self._plain(text[at:m.start()]))
            out.append(np.array([self.special[m.group()]], "<u4").tobytes())
            at = m.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, gathered from one blob by start and length."""
        i = np.frombuffer(ids, "<u4")
        lengths = self.lengths[i]
        ends = np.cumsum(lengths)
        if not len(i) or not ends[-1]:
            return b""
        where = np.arange(ends[-1]) + np.repeat(self.starts[i] - (ends - lengths), lengths)
        return self.blob[where].tobytes()


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The tokenizer of a path, built once for each worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode_docs(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                keep_ids: bool = True) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 and (``keep_ids``) ids, decoded.

    A NULL or empty text has no ids and decodes to the empty string. Repeated
    rows and NULL ids are encoded like any other. Other columns are not
    carried. No shuffle; every row is encoded whole, in its own task.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            ids = [bpe.encode(t.as_py()) for t in b.column("t")]
            raw = [bpe.decode(i) for i in ids]
            cols = [b.column("i"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols += [pa.array(ids, pa.binary()),
                         pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return (docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
            .mapInArrow(run, schema))


def digest(docs: DataFrame, path: str) -> DataFrame:
    return encode_docs(docs, path, keep_ids=False)
