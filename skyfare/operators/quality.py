"""Declarative data-quality checks: not_null and unique, per layer.

Each table is checked in a single aggregate pass; results are rows of
``(layer, test, column_name, failures)`` so they can be stored, compared
and gated like any other table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.schemas import CORE_GRAIN

RESULT_COLUMNS = ["layer", "test", "column_name", "failures"]


@dataclass(frozen=True)
class TableChecks:
    layer: str
    not_null: list[str]
    unique: list[list[str]] = field(default_factory=list)


# The checks declared for each layer (column names as in our schemas).
CHECKS = [
    TableChecks("raw", ["origin", "destination", "departure_date", "quote_ts", "price_aud"]),
    TableChecks("stg", ["route_code", "departure_date", "quote_ts", "price_aud"]),
    TableChecks("core", ["route_code", "departure_date", "quote_day",
                         "daily_min_price_aud", "observed_at"], [CORE_GRAIN]),
    TableChecks("mart", ["route_code", "origin", "destination", "departure_date",
                         "quote_day", "daily_min_price_aud", "observed_at"], [CORE_GRAIN]),
]


def unique_key_name(keys: list[str]) -> str:
    return "-".join(keys)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row. A key with any NULL part is not
    tested (the concatenated test expression would be NULL)."""
    present = df.select(*keys).dropna(how="any", subset=keys)
    return (present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def _all_present(keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def table_results(df: DataFrame, layers: list[TableChecks]) -> DataFrame:
    """Every check of the given specs in one pass over ``df``.

    Without a uniqueness check this is one global aggregate. With one, rows
    are first grouped by the key (combined map-side, so a hot key costs one
    row per task), carrying per-group NULL counts; a second, global
    aggregate sums those and counts the groups holding more than one row.
    """
    cols = sorted({c for spec in layers for c in spec.not_null})
    uniques = [keys for spec in layers for keys in spec.unique]
    if len({tuple(k) for k in uniques}) > 1:
        raise ValueError("one unique key per fused pass")
    if uniques:
        keys = uniques[0]
        grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                        *[F.count_if(F.col(c).isNull()).alias(f"_nn_{c}")
                                          for c in cols])
        totals = grouped.agg(*[F.sum(f"_nn_{c}").alias(f"_nn_{c}") for c in cols],
                             F.count_if((F.col("_n") > 1) & _all_present(keys)).alias("_dups"))
    else:
        totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_nn_{c}") for c in cols])
    stack = []
    for spec in layers:
        for c in spec.not_null:
            stack.append(F.struct(F.lit(spec.layer).alias("layer"), F.lit("not_null").alias("test"),
                                  F.lit(c).alias("column_name"),
                                  F.coalesce(F.col(f"_nn_{c}").cast("long"), F.lit(0).cast("long"))
                                  .alias("failures")))
        for keys in spec.unique:
            stack.append(F.struct(F.lit(spec.layer).alias("layer"), F.lit("unique").alias("test"),
                                  F.lit(unique_key_name(keys)).alias("column_name"),
                                  F.col("_dups").cast("long").alias("failures")))
    return totals.select(F.inline(F.array(*stack)))


def run_checks(tables: dict[str, DataFrame], checks: list[TableChecks] = CHECKS,
               raw_from_stg: bool = False, mart_from_core: bool = False) -> DataFrame:
    """All declared checks over the given layer tables, as one result frame.

    One pass per table. With ``raw_from_stg`` the RAW checks are evaluated
    on the STG frame in the same pass as the STG checks: STG passes the RAW
    columns through unchanged (same names, same types), so the NULL counts
    are identical and RAW is scanned once. ``mart_from_core`` does the same for
    MART where it is a plan over CORE, not a table of its own: its rows are
    CORE's, which is then computed once. Stored tables are checked each.
    """
    by_layer = {spec.layer: spec for spec in checks}
    parts = []
    done = set()
    fused = [("raw", "stg")] * raw_from_stg + [("mart", "core")] * mart_from_core
    for derived, read in fused:
        if read in tables and derived in by_layer and read in by_layer:
            parts.append(table_results(tables[read], [by_layer[derived], by_layer[read]]))
            done |= {derived, read}
    for spec in checks:
        if spec.layer in done or spec.layer not in tables:
            continue
        parts.append(table_results(tables[spec.layer], [spec]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> DataFrame:
    """Fail the run if any check failed. Collects only the failing check
    rows (at most one per declared check), never table data."""
    failing = results.filter(F.col("failures") > 0).collect()
    if failing:
        desc = ", ".join(f"{r.layer}.{r.test}({r.column_name})={r.failures}" for r in failing)
        raise QualityGateError(f"data quality checks failed: {desc}")
    return results
