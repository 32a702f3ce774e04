"""Packing: concatenate all token ids and cut them into fixed windows.

Pass one encodes every document once, in its own task, and writes the ids with
their place in the task's partition. The partition totals give each partition
its global offset by a prefix sum; pass two reads the ids back, adds the
offset, and cuts at every multiple of the window. A document that crosses a
window boundary, or a window that spans two partitions, yields one record on
each side; no text or id is shuffled and no sequence is padded but the last.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.bpe import LATIN_PATTERN, Bpe
from skyfare.llm.common import staged

WINDOW = 1024
END_ID = 0


class _Encoder(Bpe):
    """The tokenizer file with pieces merged by the ``tiktoken`` library, which
    gives the same ids; pre-tokens and their cache are shared with ``Bpe``."""

    def __init__(self, path: str):
        super().__init__(path)
        core = tiktoken.Encoding("packing", pat_str=LATIN_PATTERN.replace("\\u0085", "\x85"),
                                 mergeable_ranks=self.id_of, special_tokens={})
        self.encode_piece = core._core_bpe.encode_single_piece


_LOADED: dict[str, _Encoder] = {}


def _load(path: str) -> _Encoder:
    if path not in _LOADED:
        _LOADED[path] = _Encoder(path)
    return _LOADED[path]


def encode_partitions(docs: DataFrame, path: str, id_col: str, text_col: str,
                      end_id: int = END_ID) -> DataFrame:
    """id, part, start (ids before it in the part), ids: written once."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _load(path)
        width = "<u2" if len(enc.bytes_of) <= 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, starts = [], []
            for t in b.column("t"):
                x = np.frombuffer(enc.encode(t.as_py()) + end, "<u4")
                starts.append(at)
                at += len(x)
                ids.append(x.astype(width).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), pa.array([part] * len(ids), pa.int32()),
                 pa.array(starts, pa.int64()),
                 pa.array([at] * len(ids), pa.int64()),
                 pa.array([int(width[2])] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                ["i", "part", "start", "so_far", "width", "ids"])

    return staged(docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
                  .mapInArrow(run, f"i {id_type}, part int, start bigint, so_far bigint, width int, "
                                   "ids binary"), "packing-ids")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and (``keep_ids``) ids as little-endian unsigned 32-bit integers.

    - NULL or empty text: only ``end_id``, one piece of length 1.
    - NULL ids and repeated rows are packed like any other row, each with its
      own ids. Other columns are not carried. An empty table has no pieces.
    - All sequences hold ``window`` ids but the last, which holds what is left.

    The driver sees one total per partition of the input; nothing else.
    """
    ids = encode_partitions(docs, path, id_col, text_col, end_id)
    totals = sorted((r["part"], r["n"]) for r in
                    ids.groupBy("part").agg(F.max("so_far").alias("n")).collect())
    base, at = [], 0
    for part, n in totals:
        base.append((part, at))
        at += n
    offsets = F.broadcast(ids.sparkSession.createDataFrame(base, "part int, base long"))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, "
              "doc_tokens bigint, sequence_id bigint, offset bigint"
              + ", ids binary" * keep_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, rows, kept = [], [], []
            for k, (at, width, raw) in enumerate(zip(
                    b.column("at").to_pylist(), b.column("width").to_pylist(), b.column("ids"))):
                x = np.frombuffer(raw.as_buffer(), f"<u{width}").astype("<u4").tobytes()
                n, start = len(x) // 4, 0
                while start < n:
                    seq, off = divmod(at + start, window)
                    size = min(window - off, n - start)
                    piece = x[4 * start:4 * (start + size)]
                    who.append(k)
                    rows.append((start, size, zlib.crc32(piece), n, seq, off))
                    if keep_ids:
                        kept.append(piece)
                    start += size
            cols = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 6)]
            cols = [b.column("i").take(pa.array(who, pa.int64())), *cols]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                cols.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    placed = ids.join(offsets, "part").select("i", (F.col("base") + F.col("start")).alias("at"),
                                              "width", "ids")
    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and ids of each whole sequence; a group holds at most one
    window of ids, whatever the document."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(ordered.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
                    .alias("ids")))


def digest(docs: DataFrame, path: str) -> DataFrame:
    return pack(docs, path, keep_ids=False)
