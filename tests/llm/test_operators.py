"""Each operator against brute force on small inputs, with the odd cases:
NULLs, empty and long texts, ties, repeated rows, empty tables, name clashes."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyfare.llm import (bpe, embedding_dedup, jaccard_join, language_id, line_dedup, packing,
                         quality_rules, quotation, sharding, url_filter)
from skyfare.llm.components import connected_components

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARED = "This very line is shared by quite a lot of the documents"
ODD = [(900, None, None, None, None), (901, "", "en", None, 0), (902, " \t\n\r\x0b\x0c ", None, "s", 6),
       (903, "###", "en", "s", 3), (903, "###", "en", "s", 3), (None, SHARED, "en", "s", 9),
       (904, "word " * 30_000, "en", "s", 150_000), (905, "x" * 50_000, "en", "s", 50_000)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(3)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]


def prose(rnd, n, vocabulary="alpha beta gamma delta epsilon zeta eta theta iota kappa".split()):
    return " ".join(rnd.choice(vocabulary) + str(rnd.randrange(40)) for _ in range(n))


# -- line dedup ---------------------------------------------------------------

def test_line_dedup_drops_all_but_the_largest_holder(spark):
    rows = [(i, f"own {i}\n  {SHARED.upper() if i % 2 else SHARED}\t\nend", "en", "s", 1) for i in range(6)]
    rows += [(50, "ä" * 45 + "\n" + "Ä" * 45, "en", "s", 1)] + ODD
    got = {(r["doc_id"], r["text"]): r for r in
           line_dedup.dedup_lines(docs(spark, rows).withColumn("n_lines", F.lit("clash"))).collect()}
    for i in range(6):
        kept = [r for k, r in got.items() if k[0] == i][0]
        assert kept["n_lines"] == 3
        assert kept["n_dropped"] == (0 if i == 5 else 1)
        assert (kept["text"] == f"own {i}\nend") == (i != 5)
    assert got[(None, "")]["n_dropped"] == 1           # no id: shared lines go, none is held
    assert got[(900, None)]["n_lines"] == 1
    assert got[(50, "ä" * 45 + "\n" + "Ä" * 45)]["n_dropped"] == 0
    assert line_dedup.digest(docs(spark, [])).count() == 0


def test_line_dedup_keeps_a_repeated_row_whole(spark):
    rows = [(i, SHARED + "\nx", "en", "s", 1) for i in (1, 2, 3, 4, 5, 5)]
    got = line_dedup.digest(docs(spark, rows)).groupBy("doc_id", "n_dropped").count().collect()
    assert {(r[0], r[1], r[2]) for r in got} == {(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 0, 2)}


@pytest.mark.parametrize("call", ["lines", "quality", "language"])
def test_columns_of_any_name_come_through(spark, call):
    """Names that the operators use inside, and names of theirs that are replaced."""
    names = ["_row", "_l", "_th", "_did", "_drop", "id", "txt", "th", "pos", "key", "holder", "gone", "l", "grp", "m",
             "inv", "start", "x1", "d2", "bin", "states", "_h", "_w", "_lines", "n", "t", "i", "o", "v", "a.b", "limit"]
    replaced = {"lines": ["n_lines", "n_dropped"], "language": ["held_out", "lang_pred", "score"],
                "quality": ["n_words", "word_chars", "kept", "distance2", "base_failed", "n_symbols"]}[call]
    rows = [(i, f"{SHARED}\nown text number {i} " + prose(random.Random(i), 20), "en", "s", 1) for i in range(30)]
    frame = docs(spark, rows + ODD[:3]).withColumns({c: F.concat(F.lit(f"own {c} "), F.col("doc_id"))
                                                     for c in [*names, *replaced]})
    operator = {"lines": line_dedup.dedup_lines, "language": language_id.identify,
                "quality": quality_rules.quality_rules}[call]
    got = operator(frame).collect()
    assert len(got) == len(rows) + 3
    for r in got:
        for c in names:
            assert r[c] == f"own {c} {r['doc_id']}"
        for c in replaced:
            assert not str(r[c]).startswith("own")


# -- language ID --------------------------------------------------------------

def test_language_id_held_out_accuracy_and_unknowns(spark):
    rnd = random.Random(1)
    parts = {"aa": "ka lo mi nu", "ab": "ka lo mi sh", "ba": "ßo üt äk ör", "bb": "ßo üt äk éñ"}
    rows = [(i, " ".join("".join(rnd.choices(parts[la].split(), k=3)) for _ in range(rnd.randrange(8, 30))),
             la, "s", 1) for i, la in enumerate(rnd.choices(sorted(parts), k=400))]
    got = language_id.identify(docs(spark, rows + ODD).withColumn("score", F.lit("clash"))).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert len(held) > 80 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert language_id.digest(docs(spark, [])).count() == 0
    assert {r["lang_pred"] for r in language_id.digest(docs(spark, ODD[:3])).collect()} == {"und"}


# -- BPE ----------------------------------------------------------------------

PIECES = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "中文", "🙂", "½", "1", "23", "'s", "'ll", "'", "-",
          "***", "\u0085", "\xa0", "\x1c", "<|endoftext|>", "A", "ſ", "\x00"]


def test_bpe_equals_the_library(library):
    rnd, own = random.Random(2), bpe.Bpe(TOKENIZER)
    texts = ["".join(rnd.choices(PIECES, k=rnd.randrange(50))) for _ in range(1500)]
    texts += ["a" * 3001, "ab" * 2000, " " * 500, "".join(rnd.choices("abcdefgh", k=20_000))]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_bpe_rows(spark, library):
    for r in bpe.encode_docs(docs(spark, ODD), TOKENIZER).collect():
        assert r["n_tokens"] * 4 == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(r["ids"]).hexdigest()
    got = bpe.encode_docs(docs(spark, ODD), TOKENIZER)
    assert got.filter("doc_id = 900").first()["decoded"] == ""
    assert got.filter("doc_id = 903").count() == 2
    assert bpe.digest(docs(spark, []), TOKENIZER).count() == 0


# -- Jaccard join -------------------------------------------------------------

def test_language_id_learns_every_language_and_passes_quota_on(spark):
    rows = [(i, f"{'abcde'[i % 5] * 3} {'vwxyz'[i % 5] * 4} text", f"l{i % 5}", "s", 1) for i in range(60)]
    model = language_id.train(docs(spark, rows), max_train=2)
    assert sorted(x for f in model.families for x in f) == [f"l{i}" for i in range(5)]
    assert language_id._quota([2, 1000, 1000], 1000) == 499
    assert language_id._quota([5, 7], 1000) == 7 and language_id._quota([9] * 50, 20) == 1
    assert language_id.MAX_TRAIN == 3000


def components_of(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize(("size", "percent", "hot"), [(4, 85, 128), (5, 80, 3)])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, size, percent, hot):
    monkeypatch.setattr(jaccard_join, "HOT_LIST", hot)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rnd, texts = random.Random(3), []
    for _ in range(12):
        base = prose(rnd, rnd.randrange(5, 120)).split()
        for _ in range(rnd.randrange(1, 9)):
            t = list(base)
            for _ in range(rnd.randrange(0, 5)):
                t[rnd.randrange(len(t))] = "edit" + str(rnd.randrange(99))
            texts.append(" ".join(t))
    texts += ["one two", "One\tTWO", "one", None, "", "  "]
    sets = {}
    for i, t in enumerate(texts):
        w = words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    pairs = [(a, b) for a in sets for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = components_of(pairs, sets)
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[0], None, None, None)]
    got = jaccard_join.link_documents(docs(spark, rows), size=size, percent=percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])


def test_jaccard_on_nothing(spark):
    assert jaccard_join.digest(docs(spark, [])).count() == 0
    got = jaccard_join.digest(docs(spark, ODD[:3])).collect()
    assert {(r["n_shingles"], r["doc_id"] == r["component_id"]) for r in got} == {(0, True)}


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in
           connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# -- embeddings ---------------------------------------------------------------

@pytest.mark.parametrize("block", [512, 16])
def test_embedding_links_equal_brute_force(spark, block):
    rnd = np.random.default_rng(4)
    rows, label = [], 0
    for k in range(30):
        base = rnd.standard_normal(16)
        for _ in range(int(rnd.integers(1, 12))):
            rows.append((len(rows), [float(x) for x in base + 0.05 * rnd.standard_normal(16)], k % 3))
    rows += [(len(rows) + j, rows[0][1], 0) for j in range(4)]
    bad = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] * 16]
    odd = [(5000 + j, v, 0) for j, v in enumerate(bad)] + [(6000, rows[0][1], None)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(frame, block=block).collect()}
    x = np.array([np.float32(r[1]) for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    links = (x @ x.T >= 0.93) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(links, False)
    want = components_of(zip(*np.nonzero(links)), range(len(rows)))
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (links[i].sum(), want[i])
        assert got[i]["kept"] == (want[i] == i)
    for i, *_ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert embedding_dedup.digest(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1_000, 50_000, 10**7, 10**10])
def test_embedding_tables_follow_the_size_and_keep_the_recall(n):
    tables, bits = embedding_dedup.shape(n)
    p = 1 - np.arccos(0.93) / np.pi
    assert (1 - p ** bits) ** tables <= embedding_dedup.MISS
    assert n / 2 ** bits <= 512  # a bucket of unrelated vectors fits a block
    more, finer = embedding_dedup.shape(1_000 * n)
    assert finer >= bits and more <= 1_000 ** 0.25 * tables  # tables grow slower than the fourth root of n
    assert embedding_dedup.shape(n, threshold=1.0)[0] == 1


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_pairs_at_the_threshold_are_found(spark, kind):
    """Pairs just above 0.93 in one label, copies in a third of its rows."""
    rnd = np.random.default_rng(8)
    rows = []
    for k in range(1_200):
        a, b = rnd.standard_normal((2, 24))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        for v in (a, 0.9301 * a + np.sqrt(1 - 0.9301 ** 2) * b):
            rows.append((len(rows), [float(x) for x in v], "one"))
    rows += [(len(rows) + j, rows[0][1], "one") for j in range(1_200)]
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label string")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(frame.repartition(5)).collect()}
    x = np.array([r[1] for r in rows], np.float32 if kind == "float" else np.float64).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= 0.93
    np.fill_diagonal(links, False)
    want = components_of(zip(*np.nonzero(links)), range(len(rows)))
    assert got.keys() == set(range(len(rows)))
    missed = sum((got[i]["n_links"], got[i]["component_id"]) != (links[i].sum(), want[i]) for i in got)
    assert missed == 0


def test_counts_of_all_tasks_are_summed_by_blocks(spark):
    rnd = random.Random(21)
    texts = [prose(rnd, rnd.randrange(0, 80)) for _ in range(300)] + [None, "", "one two three four"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(7)
    want = np.zeros(jaccard_join.CELLS, np.int64)
    for t in texts:
        np.add.at(want, jaccard_join._cells(jaccard_join.shingles(t, 4)), 1)
    got = jaccard_join._merge_counts(jaccard_join._scan(frame, 4))
    assert got.dtype == np.uint32 and (got == want).all() and want.sum() > 1000
    assert not jaccard_join._merge_counts(jaccard_join._scan(frame.limit(0), 4)).any()


# -- sharding -----------------------------------------------------------------

def test_sharding_is_even_gapless_and_keeps_small_groups_together(spark):
    rnd = random.Random(5)
    rows = [(10_000 + i, prose(rnd, rnd.randrange(1, 60)), "en", "s", 1) for i in range(3000)]
    rows += [(4000 + i, "the same text for a third of all rows " * 3, "en", "s", 1) for i in range(1500)]
    rows += [(7000 + i, rows[i // 2][1], "en", "s", 1) for i in range(200)] + ODD[:5]
    got = sharding.digest(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    sizes = [sum(r["size"] for r in by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) < 0.05 * max(sizes)
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    text = {r[0]: r[1] or "" for r in rows}
    where = {}
    for r in got:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        where.setdefault(raw, set()).add(r["shard"])
    assert all(len(s) == 1 for t, s in where.items() if not t.startswith(b"the same"))
    assert sharding.digest(docs(spark, [])).count() == 0


@pytest.mark.parametrize("same", [17, None])
def test_sharding_spreads_a_repeated_row(spark, same, monkeypatch):
    rnd = random.Random(15)
    rows = [(10_000 + i, prose(rnd, rnd.randrange(1, 60)), "en", "s", 1) for i in range(3000)]
    rows += [(same, "one row again and again " * 8, "en", "s", 1)] * 1500
    drawn, cut = [], sharding._splitters

    def spy(keys, step):
        drawn.append((cut(keys, step), keys))
        return drawn[-1][0]
    monkeypatch.setattr(sharding, "_splitters", spy)
    got = sharding.digest(docs(spark, rows)).collect()
    sizes, hot = [0] * 8, [0] * 8
    for r in got:
        sizes[r["shard"]] += r["size"]
        hot[r["shard"]] += r["doc_id"] == same
    assert len(got) == len(rows) and sum(hot) == 1500
    assert max(sizes) - min(sizes) < 0.05 * max(sizes)
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    # Ranges cut the repeated row: none holds much of it.
    first, keys = drawn[0]
    in_range = (keys.filter("_id = 17" if same else "_id IS NULL").groupBy(sharding._range_of(first)).count())
    assert max(r["count"] for r in in_range.collect()) < 200


# -- quotation linking --------------------------------------------------------

def test_quotes_link_to_their_origin(spark):
    rows = [(1, 0, "user", "How are   you today?"), (1, 1, "bot", "Fine, and you?"),
            (1, 2, "user", "> how are you TODAY?\nI asked first"),
            (1, 3, "bot", "> > How are you today?\n> I asked first\nSo you did"),
            (1, 4, "user", "no quote here"), (1, 4, "user", "no quote here"), (1, 5, None, None),
            (2, 0, "user", "> quoted from nowhere"), (None, 0, "user", "x"), (3, None, "user", "y")]
    m = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    linked = quotation.link_quotes(m)
    got = {(r["conv_id"], r["turn"], r["copy"]): r for r in linked.collect()}
    assert len(got) == len(rows)
    assert got[1, 2, 0]["parent_turn"] == 0 and got[1, 2, 0]["n_linked"] == 1
    assert got[1, 2, 0]["body"] == "I asked first"
    assert got[1, 3, 0]["parent_turn"] == 2 and got[1, 3, 0]["max_level"] == 2
    assert got[1, 3, 0]["n_linked"] == 2
    assert got[1, 4, 1]["parent_turn"] == 3 and got[1, 5, 0]["body"] == ""
    assert got[2, 0, 0]["n_linked"] == 0 and got[2, 0, 0]["parent_turn"] is None
    assert got[None, 0, 0]["position"] is None and got[3, None, 0]["position"] is None
    order = sorted((r["position"], k) for k, r in got.items() if k[0] == 1)
    assert [k[1] for _, k in order] == [0, 1, 2, 3, 4, 4, 5]
    chat = quotation.format_chat(linked).filter("conv_id = 1").first()["chat"]
    assert "> " not in chat and chat.startswith("user: How are   you today?")
    assert quotation.digest(m.limit(0)).count() == 0


def test_quotes_of_a_part_link_to_their_origin(spark):
    letter = "Dear all,\nthe first point\nis here.\n\nThe second point\nis there.\n\nThe third\nis last."
    rows = [(1, 0, "a", letter), (1, 1, "b", "is here.\nsomething else"), (1, 2, "c", "noise"),
            (1, 3, "d", "> the SECOND point\n> is there.\nagreed"),
            (1, 4, "e", "> is last.\nno\n> the first  point\n> is here.\n>\n> The second point\nyes"),
            (1, 5, "f", "> The second point is\n> there.\nwrapped otherwise"),
            (1, 6, "g", "> > is last.\n> no\nlevels"),
            (1, 7, "h", "> is here.\n> The third\nnot side by side"),
            (1, 8, "i", "> is here.\nthe latest with that line"),
            (2, 0, "a", "x\r\n\r\ny\r\nz"), (2, 1, "b", "noise"), (2, 2, "c", "> y\r\n> z\r\nok"),
            (3, 0, "a", "the first point"), (3, 1, "b", "no quote")]
    m = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["n_linked"])
           for r in quotation.link_quotes(m.repartition(3)).collect()}
    assert got == {(1, 0): (None, 0), (1, 1): (0, 0), (1, 2): (1, 0), (1, 3): (0, 1), (1, 4): (0, 2),
                   (1, 5): (3, 1), (1, 6): (4, 2), (1, 7): (6, 0), (1, 8): (7, 1),
                   (2, 0): (None, 0), (2, 1): (0, 0), (2, 2): (0, 1), (3, 0): (None, 0), (3, 1): (0, 0)}


def by_hand(rows):
    """{(conv, turn, copy): (parent, position)} by a plain walk of whole-line quotes."""
    out, convs = {}, {}
    for c, t, _, x in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        convs.setdefault(c, {}).setdefault(t, []).append(x)
    for c, turns in convs.items():
        up, order = {}, sorted(turns)
        for i, t in enumerate(order):
            for k, x in enumerate(turns[t]):
                quote = x.split("\n")[0][2:] if x.startswith("> ") else None
                found = [u for u in order[:i] if quote and any(quote in y.replace("> ", "").split("\n") for y in turns[u])]
                out[c, t, k] = max(found) if found else order[i - 1] if i else None
            up[t] = min((out[c, t, k] for k in range(len(turns[t]))), default=None) if i else None
        paths, at = {}, 0
        for t in order:
            paths[t] = (*paths.get(up[t], ()), t)
        for t in sorted(order, key=paths.get):
            for k in range(len(turns[t])):
                out[c, t, k] = out[c, t, k], at
                at += 1
    return out


def test_long_branching_conversations_are_ordered_by_ranges(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(1, t, "u", f"> line {rnd.randrange(t)}\nline {t}" if t % 9 == 1 else f"line {t}") for t in range(700)]
    rows += [(2, t, "u", "> line 0\nhub" if t else "line 0") for t in range(300)]
    rows += [(3, t, "u", "> same\nsame") for t in range(300)] + [(4, t, "u", f"x{t}") for t in range(300)]
    rows += [(5, t % 40, f"r{t % 3}", f"> line {t % 7}\nline {t % 40}" if t % 4 else f"line {t % 40}") for t in range(200)]
    rows += [(None, None, "u", f"same{i % 2}") for i in range(300)]
    m = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    tables, write = {}, quotation.staged

    def spy(df, name):
        tables[name] = write(df, name)
        return tables[name]
    monkeypatch.setattr(quotation, "staged", spy)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        linked = quotation.link_quotes(m.repartition(3)).collect()
    finally:
        spark.conf.unset(coalesce)
    got = {(r["conv_id"], r["turn"], r["copy"]): (r["parent_turn"], r["position"]) for r in linked}
    assert len(got) == len(linked) == len(rows)
    want = by_hand([r for r in rows if r[0] is not None])
    assert {k: v for k, v in got.items() if k[0] is not None} == want
    assert sorted(k[2] for k in got if k[0] is None) == list(range(300))
    # No path is kept of a message, and ranges cut conversations.
    assert not any(kind.startswith("array") for name, x in tables.items() for _, kind in x.dtypes
                   if name not in ("messages", "passages"))
    assert tables["turns"].filter("conv = 1").select("part").distinct().count() > 1


def test_runs_of_a_repeated_line_are_found_without_hashing_each(spark):
    # 2,000 equal lines, and replies that quote 1 to 120 of them; one quotes more.
    rows = [(1, 0, "a", "\n".join(["same"] * 2000) + "\nend")]
    rows += [(1, t, "b", "> same\n" * t + f"reply {t}") for t in range(1, 121)]
    rows += [(1, 121, "c", "> same\n> same\n> end\nthe end"), (1, 122, "c", "> same\n" * 2001 + "too many"),
             (1, 123, "c", "x" * 300_000 + "\n> no such line " + "y" * 100_000)]
    m = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["turn"]: r for r in quotation.link_quotes(m).collect()}
    assert all(got[t]["n_linked"] == 1 for t in range(1, 121))
    # A passage of t lines lies in the longer one of no earlier reply, so the first message is its origin.
    assert [got[t]["parent_turn"] for t in range(1, 121)] == [0] * 120
    assert (got[121]["n_linked"], got[121]["parent_turn"]) == (1, 0)
    assert (got[122]["n_linked"], got[122]["parent_turn"]) == (0, 121)
    assert got[123]["n_linked"] == 0 and len(got[123]["body"]) == 300_000


def test_quoted_conversations_match_the_sql(spark):
    """Random quotes of whole messages, paragraphs, runs of lines, quotes of
    quotes, wrapped otherwise, of nothing, in any conversation; the linking of
    the query against its SQL."""
    rnd = random.Random(12)
    rows = []
    for c in range(60):
        said = []
        for t in range(rnd.randrange(1, 12)):
            for _ in range(rnd.choice([1, 1, 1, 2])):
                lines = [" ".join(rnd.choices("a b c D é".split(), k=rnd.randrange(0, 3))) for _ in range(rnd.randrange(1, 7))]
                for _ in range(rnd.randrange(0, 3) if said else 0):
                    old = rnd.choice(said).split("\n")
                    i = rnd.randrange(len(old))
                    part = rnd.choice([old, old[i:], old[i:i + rnd.randrange(1, 4)], [" ".join(old)], ["nothing"]])
                    at = rnd.randrange(len(lines) + 1)
                    lines[at:at] = [rnd.choice(["> ", ">", " >"]) + x.upper() if rnd.random() < 0.3 else "> " + x for x in part]
                said.append("\n".join(lines))
                rows.append((c, t * 2, rnd.choice(["u", "b"]), said[-1], 1, 2))
    rows.append((1000, 0, "u", None, 1, 2))
    m = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, copy int, position int")
    got = quotation.digest(m.repartition(5))
    cols = sorted(got.columns)
    con = duckdb.connect()
    con.register("conversations", m.toPandas())
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({quotation.ORACLE_SQL}) x").fetchall()
    con.close()
    got = [tuple(r) for r in got.select(*cols).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[cols.index("n_linked")] for r in got) > 100


# -- quality rules ------------------------------------------------------------

def base_by_hand(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_quality_base_counts(spark):
    rnd = random.Random(6)
    rows = [(i, "\n".join(rnd.choice(["a b c d e f", "a b c", "x # | y", "", " \t", prose(rnd, 7)])
                          for _ in range(rnd.randrange(12))), "en", "s", 1) for i in range(60)]
    frame = docs(spark, rows + ODD).withColumn("kept", F.lit("clash"))
    for r in quality_rules.quality_rules(frame).collect():
        n = base_by_hand(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.digest(docs(spark, [])).count() == 0


def test_quality_rejects_outliers_by_the_estimate(spark):
    rnd = random.Random(7)
    rows = [(i, prose(rnd, rnd.randrange(20, 200)), "en", f"s{i % 2}", 1) for i in range(600)]
    rows += [(1000 + i, " ".join(f"{w}***" for w in prose(rnd, 80).split()), "en", "s0", 1) for i in range(30)]
    out = quality_rules.quality_rules(docs(spark, rows)).collect()
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in out)
    # The distance of a row against the same estimate in numpy.
    units = [quality_rules.UNIT / f for _, f in quality_rules.FEATURES.values()]
    floor = quality_rules.UNIT ** 2
    stat = {r["doc_id"]: np.array([round(v * u) for v, u in zip((
        np.log(r["n_words"]), np.log((r["word_chars"] + 100) / (r["n_words"] + 20)),
        r["n_symbols"] / r["word_chars"], np.log(1 + r["n_dup_lines"]),
        r["n_repeat_words"] / r["n_words"]), units)], float) for r in out}
    x = np.array([stat[r["doc_id"]] for r in out if r["source"] == "s0"])

    def distance(m, inv):
        return np.einsum("ij,jk,ik->i", x - m, inv, x - m)

    def spread(rows, scale):
        c = scale * np.cov(rows.T, bias=True)
        np.fill_diagonal(c, np.maximum(np.diag(c), floor))
        return rows.mean(axis=0), np.linalg.inv(c), np.linalg.slogdet(c)[1]
    m = np.median(x, axis=0)
    inverse = np.diag(1 / np.maximum(2.2 * np.median(abs(x - m), axis=0) ** 2, floor))
    ended = []
    for was in ((m, inverse, np.inf), (m, inverse * np.diag([1, 1, 1e-6, 1e-6, 1e-6]), np.inf), spread(x, 1.0)):
        fell = True
        while fell:
            bins = np.round(200 * np.log(np.maximum(distance(*was[:2]), 0) + 0.01))
            now = spread(x[bins <= np.quantile(bins, 0.75)], 1.41)
            fell = now[2] < was[2] - quality_rules.SETTLED
            was = now if fell else was
        ended.append(was)
    best = min(ended, key=lambda s: s[2])
    last = spread(x[distance(*best[:2]) <= 12.83], 1.056)
    got = np.array([r["distance2"] for r in out if r["source"] == "s0"])
    assert np.allclose(got, distance(*last[:2]), rtol=1e-6)


def test_quality_groups_of_null_are_their_own(spark):
    """A NULL source with rows enough is no pooled group, nor the other way round."""
    rnd = random.Random(17)
    rows = [(i, prose(rnd, 300), "en", None, 1) for i in range(60)]
    rows += [(100 + i, prose(rnd, 12), "en", f"small{i % 30}", 1) for i in range(60)]
    rows += [(200 + i, prose(rnd, 90), None, None, 1) for i in range(60)]
    rows += [(300 + i, prose(rnd, 30), None, f"small{i % 30}", 1) for i in range(60)]
    base = quality_rules.base_columns(docs(spark, rows), "text")
    groups, state = quality_rules.estimate(base, min_group=50)
    of = {(r["lang"], r["source"]): r["grp"] for r in groups.collect()}
    assert len({of["en", None], of["en", "small0"], of[None, None], of[None, "small0"]}) == 4
    assert of["en", "small0"] == of["en", "small7"] and state.count() == 4
    length = {r["grp"]: r["m"][0] / quality_rules.UNIT * 0.05 for r in state.collect()}
    assert abs(length[of["en", None]] - np.log(300)) < 0.1 and abs(length[of["en", "small0"]] - np.log(12)) < 0.1


def test_quality_takes_the_start_of_least_determinant(spark):
    """Three fifths of the rows are junk of another kind: the estimate is of
    the tightest three quarters, not of what the median happens to lie in."""
    rnd = random.Random(18)
    rows = [(i, prose(rnd, rnd.randrange(95, 105)), "en", "s", 1) for i in range(400)]
    rows += [(1000 + i, prose(rnd, rnd.randrange(10, 5000)), "en", "s", 1) for i in range(60)]
    out = quality_rules.quality_rules(docs(spark, rows)).collect()
    assert all(r["kept"] for r in out if r["doc_id"] < 1000)
    assert sum(not r["kept"] for r in out if r["doc_id"] >= 1000) > 50


# -- packing ------------------------------------------------------------------

def test_packing_tiles_every_id_once(spark, library):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, rnd.randrange(0, 900)), "en", "s", 1) for i in range(40)]
    rows += [r for r in ODD if r[0] not in (903, None)]
    pieces = packing.pack(docs(spark, rows), TOKENIZER)
    got = pieces.collect()
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
           for i, t, *_ in rows}
    assert sum(r["length"] for r in got) == sum(map(len, ids.values()))
    for r in got:
        raw = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()
        assert bytes(r["ids"]) == raw and zlib.crc32(raw) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    spans = sorted((r["sequence_id"] * 1024 + r["offset"], r["length"]) for r in got)
    at = 0
    for start, n in spans:
        assert start == at and start % 1024 + n <= 1024
        at += n
    full = packing.sequences(pieces).collect()
    assert sorted(len(r["ids"]) for r in full)[1:] == [4096] * (len(full) - 1)
    assert packing.digest(docs(spark, []), TOKENIZER).count() == 0


# -- URL filter ---------------------------------------------------------------

@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://a.example.net/de/", "a.example.net", "/de/", "net/", "block"),
    ("http://xexample.com/de/", "xexample.com", "/de/", None, "allow"),
    ("x://example.com/de/://", "example.com", "/de/://", "example.com/de/", "block"),
    ("https://b.org/fr/spam", "b.org", "/fr/spam", "org/fr/", "allow"),
    ("https://b.org/en/spam", "b.org", "/en/spam", None, "block"),
    ("https://b.org/en/spammer", "b.org", "/en/spammer", None, "allow"),
    ("https://b.org/cheap-cheap", "b.org", "/cheap-cheap", None, "allow"),
    ("https://b.org/cheap-Pills", "b.org", "/cheap-Pills", None, "block"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://h?x", "h", "", None, "allow")])
def test_url_rules_and_terms(spark, url, host, path, rule, verdict):
    frame = spark.createDataFrame([(1, url, "clash")], "page_id long, url string, host string")
    r = url_filter.judge_urls(frame).first()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def test_urls_by_a_vocabulary_of_ones_own(spark):
    terms = spark.createDataFrame(
        [("Foo", "strict", None), ("bar", "soft", 0.4), ("baz", "soft", 1.7), ("baz", "soft", 0.1), ("é-x", "soft", 1.6),
         ("bar", "soft", 0.4), ("a.b", "soft", 9.0)], "term string, kind string, weight double")
    urls = ["http://h/foo", "http://h/foot", "http://h/bar-BAZ", "http://h/bar", "http://h/baz/baz", "http://h/é-x.baz",
            "http://h/a.b", "http://h/a.b/bar", "x" * 300_000 + "/bar/baz", "bar" * 100_000, None]
    clash = ["low", "url_", "says", "_row", "verdict", "soft_weight", "n_soft"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns(
        {c: F.lit(f"own {c}") for c in clash})
    got = {r["page_id"]: r for r in url_filter.judge_urls(frame, terms=terms).collect()}
    assert [i for i, r in got.items() if r["verdict"] == "block"] == [0, 2, 5, 7, 8]
    assert (got[2]["n_soft"], round(got[2]["soft_weight"], 9), got[4]["n_soft"]) == (2, 2.1, 1)
    for r in got.values():
        assert all(r[c] == f"own {c}" for c in ("low", "url_", "says", "_row"))
    with pytest.raises(ValueError, match="unknown kind"):
        url_filter.judge_urls(frame, terms=terms.withColumn("kind", F.lit("odd")))
    none = url_filter.judge_urls(frame, terms=terms.limit(0)).filter("verdict = 'block'")
    assert none.count() == 0


def test_no_pages(spark):
    assert url_filter.digest(spark.createDataFrame([], "page_id long, url string")).count() == 0
