"""Scalar expressions with the exact semantics the pipeline needs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

# Whitespace at either end, as Python's str.strip() removes it (Spark's
# trim() only removes spaces).
_EDGE_WS = r"^\s+|\s+$"


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_WS, "")


def split_first(c: Column, sep: str = "-") -> tuple[Column, Column]:
    """Split on the first ``sep`` only: ``MEL-A-B`` -> (``MEL``, ``A-B``).
    Without a separator the second part is NULL (never an index error)."""
    parts = F.split(c, _regex_literal(sep), 2)
    return F.get(parts, 0), F.get(parts, 1)


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


def route_code(origin: Column, destination: Column) -> Column:
    """``origin || '-' || destination``: NULL when either side is NULL."""
    return F.concat(origin, F.lit("-"), destination)


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(str(d)).cast("date")


as_date = _lit_date


_DAY = 86_400_000_000       # microseconds
_UTC = {"UTC", "Z", "ETC/UTC", "GMT"}


def zone_clock(ts: Column, zone: str) -> Column:
    """Wall clock of an instant in ``zone``, as a timestamp without zone.

    Built from the instant's microseconds, so the session zone has no part in
    it: the way over the session's own clock would lose an hour a year.
    """
    micros = F.unix_micros(ts)
    days, rest = F.call_function("div", micros, F.lit(_DAY)), micros % _DAY
    utc = (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
           + F.make_dt_interval(days=days.cast("int"), secs=rest.cast("decimal(18,6)") / 1_000_000))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def day_start(ts: Column, zone: str | None = None) -> Column:
    """The instant at which the day containing ``ts`` begins in ``zone``.

    ``zone=None`` means the session zone. An explicit zone gives the same
    instants in any session.
    """
    if zone is None:
        return F.date_trunc("day", ts)
    if zone.upper() in _UTC:
        micros = F.unix_micros(ts)
        return F.timestamp_micros(micros - F.pmod(micros, F.lit(_DAY)))
    day = local_date(ts, zone)
    none = F.lit(0)
    return F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), none, none, none, F.lit(zone))


def local_date(ts: Column, zone: str | None = None) -> Column:
    """Calendar date of ``ts`` in ``zone``; matches ``day_start`` exactly."""
    if zone is None:
        return F.to_date(ts)
    if zone.upper() in _UTC:
        micros = F.unix_micros(ts)
        return F.date_from_unix_date(F.call_function("div", micros - F.pmod(micros, F.lit(_DAY)), F.lit(_DAY))
                                     .cast("int"))
    return zone_clock(ts, zone).cast("date")


def tolerant_double(c: Column) -> Column:
    """Numeric coercion where non-numbers become NULL."""
    return c.try_cast("double")


def aud_label(price: Column) -> Column:
    """``AUD 1,234``: grouped thousands, no decimals, ties to even."""
    return F.concat(F.lit("AUD "), F.format_number(price, 0))


def dollar_label(price: Column) -> Column:
    """``$1235``: no grouping, no decimals, ties away from zero."""
    return F.concat(F.lit("$"), F.format_string("%.0f", F.round(price, 0)))


def airline_name(code: Column, name: Column) -> Column:
    """Label lookup fallback: unknown code shows itself, NULL stays NULL."""
    return F.coalesce(name, code)


def literal_rows(spark, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small literal table built JVM-side (no Python worker round trip)."""
    if not rows:
        return empty_frame(spark, schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def empty_frame(spark, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                   for f in schema.fields])


def present(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Hand-off form for external comparison: zone-aware timestamps become
    wall-clock timestamps (of ``zone``, else the session zone) without zone."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            at = F.col(f"`{f.name}`")
            cols.append((zone_clock(at, zone) if zone else at.cast("timestamp_ntz")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
