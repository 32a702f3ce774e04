import pytest

from conftest import SF001, quote
from skyfare.operators import layers, quality
from skyfare.plans import catalog


def test_clean_data_passes_all_23_checks(spark):
    res = catalog.q_dq_checks(spark, SF001)
    rows = res.collect()
    assert len(rows) == 23
    assert sum(r.failures for r in rows) == 0
    quality.gate(res)


def test_seeded_defects_are_counted(spark):
    rows = {(r.layer, r.test, r.column_name): r.failures
            for r in catalog.q_dq_checks_seeded(spark, SF001).collect()}
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    n97 = ev.filter("event_id % 97 = 0").count()
    n101 = ev.filter("event_id % 101 = 0").count()
    assert rows[("raw", "not_null", "price_aud")] == n97
    assert rows[("raw", "not_null", "origin")] == n101
    assert rows[("stg", "not_null", "route_code")] == n101
    assert rows[("core", "unique", "route_code-departure_date-quote_day")] > 0
    assert rows[("mart", "unique", "route_code-departure_date-quote_day")] == \
        rows[("core", "unique", "route_code-departure_date-quote_day")]
    with pytest.raises(quality.QualityGateError):
        quality.gate(catalog.q_dq_checks_seeded(spark, SF001))


def test_unique_ignores_keys_with_null_parts(raw_df):
    raw = raw_df([quote(dest=None), quote(dest=None, price="5.00")])
    core = layers.stg_quotes(raw)
    dup = quality.duplicate_keys(core, ["route_code", "departure_date"])
    assert dup.count() == 0
    raw2 = raw_df([quote(), quote(price="5.00")])
    assert quality.duplicate_keys(layers.stg_quotes(raw2), ["route_code", "departure_date"]).count() == 1


def test_fused_passes_count_what_separate_ones_do(spark):
    tables = catalog._seeded_layers(spark, SF001)
    fused = quality.run_checks(tables, raw_from_stg=True, mart_from_core=True)
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, quality.run_checks(tables).collect()))


def test_checks_over_lazy_layers_compute_core_once(spark):
    plan = catalog.q_dq_checks(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Window ") for line in plan.splitlines()) == 1
