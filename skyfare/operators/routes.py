"""Route resolution: parse route strings from each source, pick the first
non-empty source, expand to the request grid."""

from __future__ import annotations

import logging
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare import constants as C
from skyfare.functions import split_first, strip_ws
from skyfare.session import scratch_path

PAIR = ["origin", "destination"]


def routes_from_dim(dim: DataFrame, col: str = "route_code") -> DataFrame:
    """Dimension strings like ``MEL-BKK`` -> (origin, destination).

    Skips NULL, empty and dash-less values; strips whitespace, upper-cases,
    splits on the first dash. The two parts are not stripped again.
    """
    rc = F.col(col)
    ok = dim.filter(rc.isNotNull() & (rc != "") & rc.contains("-"))
    o, d = split_first(F.upper(strip_ws(rc)))
    return ok.select(o.alias("origin"), d.alias("destination"))


def routes_from_csv(lists: DataFrame, col: str = "routes_csv",
                    keep: list[str] | None = None) -> DataFrame:
    """``A-B;C-D`` lists -> one (origin, destination) per valid token.

    Tokens are stripped and upper-cased; empty and dash-less tokens are
    skipped; both parts are stripped after the split on the first dash.
    ``pos`` keeps each token's position within its list.
    """
    keep = keep or []
    tok = lists.select(*keep, F.posexplode(F.split(F.col(col), ";")).alias("pos", "token"))
    tok = tok.withColumn("token", F.upper(strip_ws(F.col("token"))))
    tok = tok.filter((F.col("token") != "") & F.col("token").contains("-"))
    o, d = split_first(F.col("token"))
    return tok.select(*keep, "pos", strip_ws(o).alias("origin"), strip_ws(d).alias("destination"))


def routes_default(lists: DataFrame, origin: Column | str = C.DEFAULT_ORIGIN,
                   dests_col: str = "destinations", keep: list[str] | None = None) -> DataFrame:
    """Origin plus a ``BKK,PNH,...`` list -> (origin, destination) pairs.

    The origin is upper-cased only; destinations are stripped, upper-cased
    and empty entries skipped.
    """
    keep = keep or []
    origin_col = F.lit(origin) if isinstance(origin, str) else origin
    ex = lists.select(*keep, F.upper(origin_col).alias("origin"),
                      F.posexplode(F.split(F.col(dests_col), ",")).alias("pos", "dest"))
    ex = ex.withColumn("dest", strip_ws(F.col("dest"))).filter(F.col("dest") != "")
    return ex.select(*keep, "pos", "origin", F.upper("dest").alias("destination"))


def default_routes(spark: SparkSession, origin: str = C.DEFAULT_ORIGIN,
                   destinations: str = C.DEFAULT_DESTINATIONS) -> DataFrame:
    lists = spark.range(1).select(F.lit(destinations).alias("destinations"))
    return routes_default(lists, origin).select(*PAIR)


def resolve_routes(sources: list[DataFrame | Callable[[], DataFrame] | None]) -> DataFrame:
    """First non-empty source wins; duplicates within it are kept.

    Sources are tried in turn, and what stands behind the winner is not read at
    all. A source is written to the shared folder as it is probed: it is read
    once and whole, so one that cannot be read, whether when it is planned or
    in the middle of its scan, gives way to the next one with a warning. A
    source that is None is not configured. If all are empty the result is; if
    none can be read the last error is raised.
    """
    given = [s for s in sources if s is not None]
    if not given:
        raise ValueError("no route source given")
    empty = error = None
    for prio, source in enumerate(given, start=1):
        try:
            pairs = (source() if callable(source) else source).select(*PAIR)
            path = scratch_path(pairs.sparkSession, "routes")
            pairs.write.parquet(path)
            kept = pairs.sparkSession.read.schema(pairs.schema).parquet(path)
            if kept.head(1):
                return kept
            empty = kept
        except (PySparkException, Py4JError) as e:
            error = e
            logging.getLogger("skyfare").warning("route source %d cannot be read: %s", prio, e)
    if empty is None:
        raise error
    return empty


def try_table(spark: SparkSession, name_or_path: str) -> DataFrame | None:
    """Read a routes table, or None if it cannot be read (warn and fall back)."""
    try:
        if "/" in name_or_path:
            df = spark.read.parquet(name_or_path)
        else:
            df = spark.table(name_or_path)
        df.schema  # force analysis
        return df
    except Exception as e:  # noqa: BLE001 - any read failure means "fall back"
        logging.getLogger("skyfare").warning("could not read routes from %s: %s", name_or_path, e)
        return None
