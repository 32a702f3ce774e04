"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as zstandard frames that can be read one by one, cut where a
unit (a word with the white space before it) ends, with running counts of
units and code points and the place of each frame in the blob. A cut at unit k
looks up its frame in the counts and decompresses that frame alone; outputs
and their digests are streamed frame by frame, so at no time is a text held
both whole and rearranged. An output is stored in frames as well, and the
original is rebuilt from them and the form alone.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import arrow_batch, staged

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
# Percent of texts that are rearranged, and of those the percent with the suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
FRAME_BYTES = 1 << 16
LEVEL = 1
BATCH_ROWS = 500

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_WORD_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
_MARKER = re.compile(b"<[PSM]>")
_MARKER_CUT = len(PREFIX) - 1


@dataclass
class Frames:
    """Independent frames in one blob. ``ends``, ``units`` and ``chars`` are
    the compressed bytes, units and code points up to the end of each frame."""

    blob: bytes = b""
    ends: list[int] = field(default_factory=list)
    units: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)

    def frame(self, k: int) -> bytes:
        start = self.ends[k - 1] if k else 0
        return zstandard.ZstdDecompressor().decompress(memoryview(self.blob)[start:self.ends[k]])

    def cut(self, unit: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the end of the first
        ``unit`` units. A cut between two frames decompresses neither."""
        if unit == 0:
            return 0, 0, 0
        k = bisect_left(self.units, unit)
        if self.units[k] == unit:
            return k + 1, 0, self.chars[k]
        raw, before = self.frame(k), self.units[k - 1] if k else 0
        words = _WORD.finditer(raw)
        for _ in range(unit - before):
            word = next(words)
        at = word.end()
        return k, at, (self.chars[k - 1] if k else 0) + len(raw[:at].decode())

    def span(self, start: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes]:
        """The bytes from one (frame, byte) to another, frame by frame."""
        for k in range(start[0], min(end[0], len(self.ends) - 1) + 1):
            if k == end[0] and not end[1]:
                break
            raw = self.frame(k)
            yield raw[start[1] if k == start[0] else 0:end[1] if k == end[0] else None]

    @property
    def end(self) -> tuple[int, int]:
        return len(self.ends), 0


class Writer:
    """Collects chunks into frames of about ``size`` bytes."""

    def __init__(self, size: int = FRAME_BYTES):
        self.size, self.held, self.parts = size, [], []
        self.n, self.at = 0, 0
        self.out = Frames()
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress

    def frame(self, raw: bytes, units: int = 0, chars: int = 0) -> None:
        part = self.pack(raw)
        self.at += len(part)
        self.parts.append(part)
        for total, n in ((self.out.ends, len(part)), (self.out.units, units), (self.out.chars, chars)):
            total.append((total[-1] if total else 0) + n)

    def add(self, chunk: bytes) -> None:
        self.held.append(chunk)
        self.n += len(chunk)
        if self.n >= self.size:
            self.flush()

    def flush(self) -> None:
        if self.n:
            self.frame(b"".join(self.held))
        self.held, self.n = [], 0

    def done(self) -> Frames:
        self.flush()
        self.out.blob = b"".join(self.parts)
        return self.out


def frames_of(raw: bytes, size: int = FRAME_BYTES) -> Frames:
    """A text in frames of at least ``size`` bytes (but the last) that end
    where a unit ends, so a word longer than a frame lies in one frame."""
    w, at = Writer(size), 0
    while at < len(raw):
        found = _WORD_END.search(raw, at + size - 1)
        end = found.end() if found else len(raw)
        part = raw[at:end]
        # bytes.split takes ASCII white space alone, so this counts words; what
        # is left at the end of the text is one more unit.
        units = len(part.split()) + (end == len(raw) and not _WORD.match(part, len(part) - 1))
        w.frame(part, units, len(part.decode()))
        at = end
    return w.done()


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four numbers from the hash of ``seed:id``; a NULL id is the empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def plan(doc_id, n: int, free: bool, seed: int = SEED, fim: int = FIM_PERCENT,
         spm: int = SPM_PERCENT) -> tuple[str, int, int]:
    """(form, units of the prefix, units of prefix and middle). ``free``: the
    text is not empty and holds no marker."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not free or h3 % 100 >= fim:
        return "plain", a, b
    return ("spm" if h4 % 100 < spm else "psm"), a, b


def chunks(f: Frames, form: str, a: tuple[int, int], b: tuple[int, int]) -> Iterator[bytes]:
    """The output, chunk by chunk."""
    start = 0, 0
    if form == "plain":
        yield from f.span(start, f.end)
        return
    prefix, suffix = (PREFIX, f.span(start, a)), (SUFFIX, f.span(b, f.end))
    for marker, span in (suffix, prefix) if form == "spm" else (prefix, suffix):
        yield marker
        yield from span
    yield MIDDLE
    yield from f.span(a, b)


def restore(output: Frames, form: str) -> Iterator[bytes]:
    """The original text, chunk by chunk, from the frames of an output and its
    form. Each part lies between its marker and the next one; the markers are
    found in one pass that keeps their places and no text."""
    if form == "plain":
        yield from output.span((0, 0), output.end)
        return
    marks, tail, at = [], b"", 0
    starts = [0]
    for k in range(len(output.ends)):
        raw = output.frame(k)
        # The end of the last frame goes before this one: a marker may be cut.
        for m in _MARKER.finditer(tail + raw):
            marks.append((at - len(tail) + m.start(), m.group()))
        at += len(raw)
        starts.append(at)
        tail = (tail + raw)[-_MARKER_CUT:]

    def place(byte: int) -> tuple[int, int]:
        k = bisect_left(starts, byte + 1) - 1
        return k, byte - starts[k]
    ends = [m[0] for m in marks[1:]] + [at]
    part = {name: (place(start + len(name)), place(end)) for (start, name), end in zip(marks, ends)}
    for name in (PREFIX, MIDDLE, SUFFIX):
        yield from output.span(*part[name])


def _digest(parts: Iterator[bytes]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


_FRAMES = "blob binary, ends array<bigint>, units array<bigint>, chars array<bigint>"


def _frame_columns(frames: list[Frames]) -> list[pa.Array]:
    many = pa.list_(pa.int64())
    return [pa.array([f.blob for f in frames], pa.binary()), pa.array([f.ends for f in frames], many),
            pa.array([f.units for f in frames], many), pa.array([f.chars for f in frames], many)]


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = FRAME_BYTES) -> DataFrame:
    """id, free (neither empty nor with a marker) and the frames of each text,
    written to the shared folder. NULL is stored as the empty text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            free, frames = [], []
            for t in batch.column("t"):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                free.append(bool(raw) and not _MARKER.search(raw))
                frames.append(frames_of(raw, size))
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(free, pa.bool_()), *_frame_columns(frames)],
                                             ["i", "free", "blob", "ends", "units", "chars"])

    with arrow_batch(docs.sparkSession, BATCH_ROWS):
        return staged(docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
                      .mapInArrow(run, f"i {id_type}, free boolean, {_FRAMES}"), "middle-frames")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   fim: int = FIM_PERCENT, spm: int = SPM_PERCENT, size: int = FRAME_BYTES,
                   keep: bool = True) -> DataFrame:
    """id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256
    and (``keep``) output: the text with its middle moved to the end.

    - NULL or empty text: no units, form ``plain``, empty output.
    - A text that holds ``<P>``, ``<S>`` or ``<M>`` stays plain, so markers in
      an output are always its own.
    - A NULL id draws as the empty string; repeated rows give equal rows.
    - Other columns are not carried, so their names cannot clash. No rows in,
      no rows out.

    Both passes work in place, without a shuffle; the driver sees no rows. A
    task holds one text's frames at a time, and of the text one frame.
    """
    frames = store(docs, id_col, text_col, size)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    schema = (f"`{id_col}` {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
              "output_sha256 string, restored_sha256 string" + ", output string" * keep)

    def row(doc_id, free: bool, f: Frames) -> tuple:
        n = f.units[-1] if f.units else 0
        form, a, b = plan(doc_id, n, free, seed, fim, spm)
        lengths, cuts = (None, None), ((0, 0), (0, 0))
        if form != "plain":
            (ka, xa, chars_a), (kb, xb, chars_b) = f.cut(a), f.cut(b)
            lengths, cuts = (chars_a, chars_b - chars_a), ((ka, xa), (kb, xb))
        h, w = hashlib.sha256(), Writer(size)
        for part in chunks(f, form, *cuts):
            h.update(part)
            w.add(part)
        output = w.done()
        text = (b"".join(output.span((0, 0), output.end)).decode(),) if keep else ()
        return (n, form, *lengths, h.hexdigest(), _digest(restore(output, form)), *text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [row(i, free, Frames(*f)) for i, free, *f in zip(*(b.column(c).to_pylist() for c in (
                "i", "free", "blob", "ends", "units", "chars")))]
            cols = list(zip(*found)) if found else [()] * (len(names) - 1 + keep)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("i"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names + ["output"] * keep)

    return frames.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    return fill_in_middle(docs.select("doc_id", "text"), keep=False)


ORACLE_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
d AS (
  SELECT *, len(u) AS n,
         ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= {FIM_PERCENT} THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM t),
p AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:least(c1, c2)], '') AS prefix,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS suffix
  FROM d),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
  FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                        WHEN 'psm' THEN split_part(substr(output, 4), '<S>', 1)
                          || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
                        ELSE split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2)
                          || split_part(substr(output, 4), '<P>', 1) END) AS restored_sha256
FROM o
"""
