"""Every registered operator on the small tables: against its SQL where it has
one, else whole rows of the promised columns. The SQL of the operators that
join is also run on planted tables, where something links."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF001
from skyfare.llm import embedding_dedup, jaccard_join, queries
from skyfare.llm.common import table

ROWS_ONLY = {
    "op2_language_id": ("documents", {"doc_id", "held_out", "lang_pred", "score"}),
    "op3_bpe": ("documents", {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}),
    "op6_sharding": ("documents", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
    "op8_quality_rules": ("documents", {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                        "n_repeat_words", "base_failed", "kept"}),
    "op9_packing": (None, {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}),
    "op11_token_counts": ("documents", {"doc_id", "n_bytes", "n_tokens", "over_limit", "n_merged"}),
}


def plain(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)


def test_each_operator_is_registered_and_has_sql_or_a_test_of_rows():
    keys = set(queries.QUERIES)
    assert keys | {"pipeline"} <= set(E.queries())
    assert {int(k[2:].split("_")[0]) for k in keys} == set(range(1, 14))
    assert set(queries.ORACLE) | set(ROWS_ONLY) == keys and not set(queries.ORACLE) & set(ROWS_ONLY)
    assert set(queries.ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_operator_matches_its_sql(spark, duck, key):
    df = queries.QUERIES[key](spark, SF001)
    cols = sorted(df.columns)
    got = plain(df.select(*cols).collect())
    want = duck.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[key]}) x").fetchall()
    assert got == plain(want) and got
    assert sorted(duck.execute(queries.ORACLE[key]).description and [d[0] for d in duck.description]) == cols


@pytest.mark.parametrize("key", sorted(ROWS_ONLY))
def test_operator_returns_its_rows(spark, key):
    name, cols = ROWS_ONLY[key]
    got = queries.QUERIES[key](spark, SF001)
    assert set(got.columns) == cols
    if name:
        ids = sorted(r[0] for r in got.select("doc_id").collect())
        assert ids == sorted(r[0] for r in table(spark, SF001, name).select("doc_id").collect())


def test_pipeline_returns_pieces_of_documents(spark):
    got = E.queries()["pipeline"](spark, SF001).collect()
    known = {r[0] for r in table(spark, SF001, "documents").select("doc_id").collect()}
    assert got and {r["doc_id"] for r in got} < known
    for r in got:
        assert 0 <= r["offset"] < r["offset"] + r["length"] <= 1024 and r["start"] + r["length"] <= r["doc_tokens"]


def test_join_sql_on_planted_documents(spark):
    base = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(5)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10 + i, t + " and more") for i, t in enumerate(base[:3])]      # near copies
    rows += [(13, base[0] + " and more of it here"), (20, base[0].replace("x7 ", "y ").replace("x20", "z")), (21, base[1].upper()), (22, None), (23, ""),
             (24, "three short words"), (25, "Three  short\twords"), (26, "three short")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = plain(con.execute(f"SELECT doc_id, n_shingles, component_id FROM ({jaccard_join.ORACLE_SQL}) x").fetchall())
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = plain(jaccard_join.digest(frame).select("doc_id", "n_shingles", "component_id").collect())
    assert got == want and sum(r[0] != r[2] for r in got) >= 4


def test_join_sql_on_planted_vectors(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for i in range(12):
        v = rnd.normal(size=8)
        rows += [(len(rows) + k, [float(x) for x in v + rnd.normal(size=8) * 0.1], i % 3) for k in range(3)]
    bad = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [1.0] * 4]
    rows += [(100 + i, v, 0) for i, v in enumerate(bad)] + [(200, rows[0][1], None), (201, rows[0][1], 0)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    cols = "vec_id, n_links, component_id, kept"
    want = plain(con.execute(f"SELECT {cols} FROM ({embedding_dedup.ORACLE_SQL}) x").fetchall())
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = plain(embedding_dedup.digest(frame).select(*cols.split(", ")).collect())
    assert got == want and sum(not r[3] for r in got) >= 8
