"""Language identification and sharding against plain versions of their laws."""

import bisect
import math
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfare.llm import language_id, sharding

WRAP = 1 << 64


def plain_profile(text, dim):
    """Letters, with one space for what lies between, hashed n-gram by n-gram."""
    if not text or not any(c.isalpha() for c in text):
        return None
    codes, gap = [0], True
    for c in text.lower():
        if c.isalpha():
            codes.append(ord(c))
            gap = False
        elif not gap:
            codes.append(0)
            gap = True
    codes.append(0)
    mix, bits, out = int(language_id._MIX), int(math.log2(dim)), [0] * dim
    for n in range(1, 5):
        for i in range(len(codes) - n + 1):
            h = 0
            for k in range(n):
                h = (h * mix + codes[i + k] + k + 1) % WRAP
            out[(h * mix % WRAP) >> (64 - bits)] += 1
    norm = math.sqrt(sum(out))
    return [math.sqrt(v) / norm for v in out]


def test_profiles_equal_a_plain_count():
    rnd = random.Random(1)
    texts = ["", None, "12 !?", "a", " a", "Ab, cd!! Éß 中文 x1y", "İ" * 3]
    texts += ["".join(rnd.choices("abc éÄ 1.\n中", k=rnd.randrange(60))) for _ in range(60)]
    for t in texts:
        want, got = plain_profile(t, 256), language_id.profile(t, 256)
        assert (want is None) == (got is None), t
        if want is not None:
            assert np.allclose(got, want), t


def plain_svm(x, y, c=10.0, epochs=12):
    """Dual coordinate descent on whole Python numbers, one row at a time."""
    w, bias, alpha = [0.0] * len(x[0]), 0.0, [0.0] * len(x)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for k in rng.permutation(len(x)):
            q = sum(v * v for v in x[k]) + 1 + 0.5 / c
            g = y[k] * (sum(a * b for a, b in zip(x[k], w)) + bias) - 1 + alpha[k] * 0.5 / c
            new = max(alpha[k] - g / q, 0.0)
            step = (new - alpha[k]) * y[k]
            w = [a + step * b for a, b in zip(w, x[k])]
            bias, alpha[k] = bias + step, new
    return [*w, bias]


def sample(seed, langs, n=12, dim=64):
    rnd = random.Random(seed)
    return [(la, language_id.profile(" ".join("".join(rnd.choices(letters, k=4)) for _ in range(12)), dim))
            for la, letters in langs.items() for _ in range(n)]


LANGS = {"aa": "abcdef", "ab": "abcdeg", "ba": "uvwxyz", "bb": "uvwxyt", "cc": "mnopq"}


def test_machines_equal_a_plain_descent():
    rows = sample(2, {k: LANGS[k] for k in ("aa", "ab")})
    x = np.stack([v for _, v in rows])
    y = np.array([1.0 if la == "aa" else -1.0 for la, _ in rows])
    got = language_id._svm(x, np.arange(len(x)), y)
    assert np.allclose(got, plain_svm(x.tolist(), y.tolist()), atol=1e-4)
    # Solved: no row is far inside its margin without having a say.
    assert ((x @ got[:-1] + got[-1]) * y > 0).all()


def test_families_equal_a_plain_merge():
    rows = sample(3, LANGS)
    names = sorted(LANGS)
    means = [np.mean([v for la, v in rows if la == n], axis=0) for n in names]
    cos = {(i, j): float(means[i] @ means[j] / math.sqrt((means[i] @ means[i]) * (means[j] @ means[j])))
           for i in range(5) for j in range(5)}
    groups = [[i] for i in range(5)]
    while len(groups) > 3:
        def closeness(ab):
            a, b = ab
            return sum(cos[i, j] for i in groups[a] for j in groups[b]) / len(groups[a]) / len(groups[b])
        a, b = max(combinations(range(len(groups)), 2), key=closeness)
        groups = [g for k, g in enumerate(groups) if k not in (a, b)] + [groups[a] + groups[b]]
    got = language_id._families(np.stack(means), names)
    assert sorted(map(sorted, got)) == sorted(sorted(names[i] for i in g) for g in groups)
    assert ["aa", "ab"] in got and ["ba", "bb"] in got


def test_decisions_equal_plain_votes():
    model = language_id.fit(sample(4, LANGS))

    def votes(machine, v):
        k = len(machine.names)
        if k == 1:
            return 0, 1.0
        p = {}
        for (a, b), w in zip(machine.pairs, machine.weights):
            p[a, b] = 1 / (1 + math.exp(-4 * (sum(x * y for x, y in zip(w, v)) + w[-1])))
            p[b, a] = 1 - p[a, b]
        rank = {i: (sum(p[i, j] >= 0.5 if i < j else p[j, i] < 0.5 for j in range(k) if j != i),
                    sum(p[i, j] for j in range(k) if j != i), -i) for i in range(k)}
        best = max(rank, key=rank.get)
        return best, rank[best][1] / (k - 1)
    right = 0
    for la, v in sample(5, LANGS):
        f, pf = votes(model.outer, v)
        i, pl = votes(model.inner[f], v)
        said, score = model.predict(v)
        assert said == model.families[f][i] and abs(score - pf * pl) < 1e-9
        right += said == la
    assert right >= 0.9 * 60
    assert language_id.Model([], None, []).predict(None) == ("und", 0.0)


def test_training_ranks_only_what_lies_under_the_bound(spark, monkeypatch):
    """Of a language's rows only about as many as it gives reach its ranking."""
    seen = {}
    number = F.row_number

    def spy():
        seen["asked"] = True
        return number()
    monkeypatch.setattr(language_id.F, "row_number", spy)
    rows = [(i, f"text {i} of some words", "en" if i % 3 else "de") for i in range(6000)] + [(7, "same", "en")] * 500
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tables, write = {}, language_id.staged

    def keep(df, name):
        tables[name] = (df, write(df, name))
        return tables[name][1]
    monkeypatch.setattr(language_id, "staged", keep)
    language_id.train(frame, max_train=100, dim=64)
    assert seen["asked"] and tables["lang-profiles"][1].groupBy("l").count().filter("count = 50").count() == 2
    plan = tables["lang-profiles"][0]._jdf.queryExecution().optimizedPlan().toString()
    assert "18446744073709551616" in plan or "1.8446744073709552E19" in plan


@pytest.mark.parametrize("rows_per_range", [sharding.ROWS_PER_RANGE, 4])
def test_shards_equal_a_walk_over_the_sorted_rows(spark, rows_per_range):
    """The law `bytes`: rows in order of their text's hash, each group of equal
    texts whole in the shard that its first byte falls in, whatever the ranges."""
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choices("alpha beta gamma é 中".split(), k=rnd.randrange(1, 80)))) for i in range(4000)]
    rows += [(5000 + i, rows[i % 40][1]) for i in range(120)] + [(6000, None), (6001, ""), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    text = F.coalesce("text", F.lit(""))
    keyed = frame.select("doc_id", text.alias("t"), F.xxhash64(text).alias("k"), F.xxhash64(F.lit(1), text).alias("k2"))
    walk = sorted(((r["k"], r["k2"], r["doc_id"] is not None, r["doc_id"] or 0, len(r["t"].encode()) + 1, r["doc_id"], r["t"])
                   for r in keyed.collect()))
    total, at, first, want, slots = sum(w[4] for w in walk), 0, {}, {}, [0] * 8
    for *_, size, i, t in walk:
        first.setdefault(t, at)
        shard = min(first[t] * 8 // total, 7)
        want[i, t] = (shard, slots[shard])
        slots[shard] += 1
        at += size
    got = sharding.shard_by_bytes(frame, hot_share=1.0, rows_per_range=rows_per_range).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["shard"], r["slot"]) == want[r["doc_id"], texts[r["doc_id"]] or ""]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 5000])
def test_ranges_are_looked_up_among_any_number_of_splitters(spark, n):
    rnd = random.Random(n)
    draw = [(rnd.randrange(-40, 40), rnd.randrange(-2, 2), rnd.randrange(-2, 2)) for _ in range(3 * n)]
    big = [(rnd.randrange(-2**63, 2**63), 0, 0) for _ in range(2 * n)]
    splitters = sorted(set(rnd.sample(draw + big, n)))
    keys = draw[:500] + big[:500] + [(0, 0, 0), (2**63 - 1, 0, 0), (-2**63, 0, 0)]
    got = (spark.createDataFrame(keys, "_k long, _sub long, _salt long")
           .select("*", sharding._range_of(splitters).alias("r")).collect())
    assert [r["r"] for r in got] == [bisect.bisect_right(splitters, tuple(r)[:3]) for r in got]


def test_machines_trained_in_tasks_equal_those_trained_at_hand(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join("".join(rnd.choices(LANGS[la], k=4)) for _ in range(12)), la)
            for i, la in enumerate(rnd.choices(sorted(LANGS), k=200))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = language_id.train(frame, dim=256)
    order = {(r["l"], r["t"]): r["o"] for r in frame.select(
        F.col("lang").alias("l"), F.col("text").alias("t"), F.xxhash64("doc_id", "text").alias("o")).collect()}
    kept = [(la, t) for i, t, la in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    kept.sort(key=lambda r: (r[0], order[r]))
    want = language_id.fit([(la, language_id.profile(t, 256).astype(np.float32)) for la, t in kept])
    assert got.families == want.families
    for a, b in zip([got.outer, *got.inner], [want.outer, *want.inner]):
        assert a.names == b.names and a.pairs == b.pairs and np.allclose(a.weights, b.weights, atol=1e-6)
