"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.session import scratch_path

# ASCII white space: space, tab, LF, VT, FF, CR. Used by every word or line rule.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = "\\x20\\x09-\\x0D"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` folds all of Unicode, so it
    serves only strings whose every code point is one byte."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, LOWER)))


ROW = "_row"


def wrapped(docs: DataFrame, columns: list[str], **parts: str) -> DataFrame:
    """``columns`` of ``docs`` as one struct ``_row``, and beside it copies of
    single columns under names of our own. What is added later cannot clash
    with a column of the input, whatever that is called."""
    quoted = [F.col(f"`{c}`") for c in columns]
    row = F.struct(*quoted) if quoted else F.lit(0)
    return docs.select(row.alias(ROW), *[F.col(f"`{c}`").alias(name) for name, c in parts.items()])


def unwrapped(columns: list[str]) -> list[Column]:
    """The input's own columns out of ``_row``, for a select."""
    return [F.col(f"{ROW}.`{c}`").alias(c) for c in columns]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage there: a lost executor costs a re-read of these files,
    not of the plan above them.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """After many small jobs: have the driver collect its garbage. Spark drops
    the broadcasts, shuffle files and compiled plans that nothing refers to any
    more only when that happens, and by itself it may be long in coming."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def arrow_batch(spark: SparkSession, rows: int):
    """Bound the Arrow batches of the eager jobs run inside, for rows that
    carry whole sets or vectors."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def block_pairs(rows: DataFrame, key: list[str], member: str, block: int) -> DataFrame:
    """Deal the rows of each key out so that any two meet in one unit
    (key, x, y) of at most about ``block`` rows. A key of up to ``block`` rows
    is one unit; a larger one is cut into blocks that meet two by two, with
    ``side`` 1 or 2 (0: both). Only sizes of large keys are joined back."""
    large = staged(rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > block)
                   .withColumn("blocks", F.ceil(2 * F.col("n") / block).cast("int")).drop("n"),
                   "large-keys")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (rows.join(large, key, "left")
             .withColumn("own", F.pmod(F.xxhash64(member), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other"),
                           "side": F.when(F.col("own") < F.col("other"), 1)
                           .when(F.col("own") > F.col("other"), 2).otherwise(0)}))
    unit = [*key, "x", "y"]
    return (dealt.drop("blocks", "own", "other").repartition(*unit)
            .sortWithinPartitions(*unit, member))


def units(batches: Iterator[pa.RecordBatch], unit: list[str]) -> Iterator[list[list[dict]]]:
    """For each batch, the units that it completes, of rows sorted by ``unit``."""
    held, at = [], None
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            k = tuple(r[c] for c in unit)
            if k != at:
                if held:
                    done.append(held)
                held, at = [], k
            held.append(r)
        yield done
    if held:
        yield [held]


def forest(links: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric boolean link matrix over ``ids``."""
    seen = np.zeros(len(ids), bool)
    out = []
    for s in range(len(ids)):
        if seen[s]:
            continue
        seen[s] = True
        stack = [s]
        while stack:
            u = stack.pop()
            new = np.flatnonzero(links[u] & ~seen)
            seen[new] = True
            out.extend((int(ids[u]), int(ids[v])) for v in new)
            stack.extend(new.tolist())
    return out
