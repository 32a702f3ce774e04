"""The stages on the small tables: each works on all that its predecessor kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from conftest import SF001
from skyfare.llm import jaccard_join, language_id, line_dedup, quality_rules
from skyfare.llm.common import staged, table


def test_stages_in_order_take_effect(spark):
    frame = table(spark, SF001, "documents")
    columns, kept = frame.columns, [frame]
    for name, stage in C.STAGES:
        kept.append(staged(stage(spark, kept[-1], SF001), f"test-{name}"))
    docs = [{r["doc_id"]: r for r in k.collect()} for k in kept[:-1]]
    assert all(k.columns == columns for k in kept[:-1])
    good = {r["doc_id"] for r in quality_rules.digest(kept[0]).filter("kept").collect()}
    assert set(docs[1]) == good and 0 < len(good) < len(docs[0])
    sure = {r["doc_id"] for r in language_id.digest(kept[1]).collect()
            if r["lang_pred"] != "und" and r["score"] >= C.MIN_LANGUAGE_SCORE}
    assert set(docs[2]) == sure
    lines = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(kept[2]).collect()}
    assert {i: r["text"] for i, r in docs[3].items()} == lines
    first = {r["component_id"] for r in
             jaccard_join.link_documents(kept[3], size=5, percent=80).collect()}
    assert set(docs[4]) == first
    pieces = kept[-1].collect()
    assert {r["doc_id"] for r in pieces} == set(docs[4])
    assert max(r["offset"] + r["length"] for r in pieces) <= 1024
    assert sorted(r["doc_id"] for r in C.run(spark, SF001).collect()) == sorted(r["doc_id"] for r in pieces)


DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SHARED = "A line of more than forty characters that is in all of the documents"
CLASH = ["kept", "distance2", "n_words", "grp", "m", "inv", "x1", "d2", "start", "_l", "_th", "_did", "_drop", "n_lines",
         "n_dropped", "score", "lang_pred", "held_out", "component_id", "n_shingles", "_extra", "_row", "id", "a.b", "i"]


def prose(seed, n=60):
    rnd = random.Random(seed)
    return " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rnd.randrange(99))
                    for _ in range(n))


def odd_rows():
    rows = [(i, f"{prose(i)}\n{SHARED}\nend {i}", "en", "s", None) for i in range(20)]
    rows += [(100, prose(1) + f"\n{SHARED}\nend 1", None, None, 7)]                        # near copy of 1
    rows += [(101, None, "en", "s", None), (102, "", None, "s", 0), (103, "?! 12", "en", None, 5)]
    rows += [(104, "long " + prose(104, 40_000), "en", "s", None), (105, "few words", "en", "s", 9)]
    rows += [(i, f"{prose(n)}\n{SHARED} too\nend {n}", "en", "s", 1) for i, n in ((106, 106), (None, 107))] * 2
    return rows


def odd(spark):
    """NULLs everywhere, empty, long and repeated rows, and columns of clashing names."""
    frame = spark.createDataFrame(odd_rows(), DOC)
    return frame.withColumns({c: F.concat_ws(" ", F.lit(f"own {c}"), "doc_id") for c in CLASH}).repartition(3)


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))


EVERY = sorted([r[0] for r in odd_rows()], key=lambda x: (x is None, x))


@pytest.mark.parametrize(("name", "gone"), [
    ("quality_rules", {101, 102, 103, 105}), ("language_id", {101, 102, 103}), ("line_dedup", set()),
    ("ngram_jaccard_join", {100})])
def test_a_stage_on_odd_rows(spark, name, gone):
    frame, stage = odd(spark), dict(C.STAGES)[name]
    kept = staged(stage(spark, frame, SF001), "odd")
    assert kept.columns == frame.columns and kept.dtypes == frame.dtypes
    rows = kept.collect()
    # The long text is an outlier among short ones, or not: the estimate says.
    free = {104} if name == "quality_rules" else set()
    assert [i for i in ids(rows) if i not in free] == [i for i in EVERY if i not in gone | free]
    for r in rows:
        for c in CLASH:
            assert r[c] == ("own " + c + ("" if r["doc_id"] is None else f" {r['doc_id']}"))
    texts = {r["doc_id"]: r for r in rows}
    given = {r[0]: r for r in odd_rows()}
    for i, r in texts.items():
        if name != "line_dedup":
            assert (r["text"], r["lang"], r["source"], r["n_chars"]) == given[i][1:]
    if name == "line_dedup":
        assert SHARED in texts[100]["text"] and texts[100]["n_chars"] == 7
        assert all(SHARED not in texts[i]["text"] and texts[i]["n_chars"] == len(texts[i]["text"]) for i in range(20))
        assert texts[101]["text"] is None and texts[101]["n_chars"] is None


def test_packing_stage_on_odd_rows(spark):
    pieces = C.pack(spark, odd(spark), SF001).collect()
    assert {r["doc_id"] for r in pieces} == set(EVERY)
    for i in (101, 102):
        assert [(r["start"], r["length"], r["doc_tokens"]) for r in pieces if r["doc_id"] == i] == [(0, 1, 1)]
    assert sum(r["start"] == 0 for r in pieces) == len(EVERY)
    assert len([r for r in pieces if r["doc_id"] == 104]) > 50


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_a_stage_on_nothing(spark, name):
    out = dict(C.STAGES)[name](spark, odd(spark).limit(0), SF001)
    assert out.count() == 0
