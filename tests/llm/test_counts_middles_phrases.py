"""Token counts, fill-in-middle and phrases against plain versions, with NULLs,
empty and long texts, ties, repeated rows, empty tables and name clashes."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyfare.llm import fill_middle, phrases, token_counts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id bigint, text string, lang string"
ODD = [(900, None, None), (901, "", "en"), (902, " \t\n\r\x0b\x0c ", None), (903, "a<S>b", "en"), (904, "a<S>b", "en"),
       (904, "a<S>b", "en"), (None, "no id at all", "en"), (905, "word " * 30_000, "en"), (906, "x" * 200_000, "en"),
       (907, "é中🙂 \xa0\x85 tail \n", None), (908, "<|endoftext|> in a text<|endoftext|>", "en")]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def frame(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(3)


# -- token counts -------------------------------------------------------------

PIECES = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "中文", "🙂", "½", "1", "23", "'s", "'ll", "'", "-", "***",
          "\u0085", "\xa0", "\x1c", "<|endoftext|>", "A", "ſ", "\x00", " qx", "zvk"]


def test_proved_strings_are_exactly_those_that_encode_alone(library):
    merges = token_counts.Merges(TOKENIZER)
    proved = set(merges.prove())
    for raw, i in merges.strings.items():
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        alone = library.encode(text, add_special_tokens=False).ids == [i]
        assert (text in proved) == alone, text
    assert 40_000 < len(proved) < len(merges.strings)


def test_token_counts_equal_the_library(library):
    rnd, own = random.Random(2), token_counts.Counter(TOKENIZER)
    texts = ["".join(rnd.choices(PIECES, k=rnd.randrange(50))) for _ in range(1500)]
    texts += ["a" * 3001, "ab" * 2000, " " * 500, "".join(rnd.choices("abcdefgh", k=20_000))]
    for t in texts:
        assert own.count(t)[0] == len(library.encode(t, add_special_tokens=False).ids)


def test_long_texts_and_a_full_cache_change_no_count(library, monkeypatch):
    monkeypatch.setattr(token_counts, "LIST_CHARS", 10)
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 3)
    rnd, own = random.Random(3), token_counts.Counter(TOKENIZER)
    for _ in range(300):
        t = "".join(rnd.choices(PIECES, k=rnd.randrange(80)))
        assert own.count(t)[0] == len(library.encode(t, add_special_tokens=False).ids)
    assert len(own.counts) <= len(own.counts.proved) + 3


def test_token_count_rows(spark, library):
    clash = frame(spark, ODD).withColumns({"n_tokens": F.lit("x"), "i": F.lit(1), "t": F.lit(2), "n": F.lit(3)})
    got = token_counts.count_tokens(clash, TOKENIZER).collect()
    assert len(got) == len(ODD)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                   for i, t, _ in ODD)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert sum(r["over_limit"] for r in got) == 2
    assert token_counts.digest(frame(spark, []), TOKENIZER).count() == 0


# -- fill-in-middle -----------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text, seed=42):
    """(n, form, prefix chars, middle chars, output) from whole strings."""
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(u), "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 80:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("size", [1, 2, 7, 1 << 16])
def test_frames_cut_where_units_end(size):
    rnd = random.Random(size)
    alphabet = ["a", " ", "\n", "é", "中", "\x85", "\xa0", "\x1c", "bb", "<", "P", ">", "S", "M"]
    for _ in range(300):
        t = "".join(rnd.choices(alphabet, k=rnd.randrange(40)))
        f, u = fill_middle.frames_of(t.encode(), size), UNIT.findall(t)
        assert (f.units[-1] if f.units else 0) == len(u)
        assert b"".join(f.frame(k) for k in range(len(f.ends))).decode() == t
        cuts = sorted(rnd.randrange(len(u) + 1) for _ in range(2))
        (ka, xa, ca), (kb, xb, cb) = map(f.cut, cuts)
        p, m, s = "".join(u[:cuts[0]]), "".join(u[cuts[0]:cuts[1]]), "".join(u[cuts[1]:])
        assert (ca, cb) == (len(p), len(p + m))
        if re.search("<[PSM]>", t):
            continue
        for form, want in (("plain", t), ("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
            w = fill_middle.Writer(size)
            for part in fill_middle.chunks(f, form, (ka, xa), (kb, xb)):
                w.add(part)
            out = w.done()
            assert b"".join(out.span((0, 0), out.end)).decode() == want
            assert b"".join(fill_middle.restore(out, form)).decode() == t


def test_only_cut_frames_are_decompressed(monkeypatch):
    f = fill_middle.frames_of(b"word " * 10_000, 1000)
    read, frame_of = [], fill_middle.Frames.frame

    def spy(self, k):
        read.append(k)
        return frame_of(self, k)
    monkeypatch.setattr(fill_middle.Frames, "frame", spy)
    assert len(f.ends) > 40
    f.cut(5003)
    assert len(read) == 1
    f.cut(f.units[7])
    assert len(read) == 1


@pytest.mark.parametrize("size", [16, 1 << 16])
def test_fill_middle_rows(spark, size):
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choices(["a ", "bc\n", "é", " ", "中 "], k=rnd.randrange(60))), "en") for i in range(150)]
    rows += ODD[:8] + ODD[9:]
    clash = frame(spark, rows).withColumns({"n": F.lit("x"), "blob": F.lit(1), "i": F.lit(2), "form": F.lit(3)})
    got = fill_middle.fill_in_middle(clash, size=size).collect()
    want = Counter((i, *by_hand(i, t)) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
                   for r in got) == want
    texts = {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows}
    for r in got:
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
        assert (r["doc_id"], r["restored_sha256"]) in texts
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.digest(frame(spark, [])).count() == 0


# -- phrases ------------------------------------------------------------------

def mined(rows, max_words=3, min_count=10, absorb=50, top=2000):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    out = set()
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = {}
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i:i + m]
                    inside[q] = max(inside.get(q, 0), a)
        rows = []
        for p, a in found.items():
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if 100 * inside.get(p, 0) < absorb * a:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return out


def talk(rnd, n, words):
    return "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", ". ", "\n", " , "]) for _ in range(n))


@pytest.mark.parametrize(("bits", "max_words", "block"), [(64, 3, 200_000), (64, 4, 7), (5, 3, 200_000), (9, 3, 13)])
def test_phrases_equal_brute_force(spark, monkeypatch, bits, max_words, block):
    """Few bits make nearly every fingerprint collide; short blocks cut phrases."""
    monkeypatch.setattr(phrases, "BUFFER_GRAMS", 500)
    rnd = random.Random(bits)
    words = ["alpha", "Beta", "gamma", "delta", "É", "éa", "b", "中文", "x-y", "'s", "\x85", "#"]
    rows = [(i, talk(rnd, rnd.randrange(0, 60), words[:rnd.randrange(2, 13)]), rnd.choice(["en", "de", None, "und"]))
            for i in range(120)] + [r for r in ODD if r[0] not in (905, 906)] * 2
    got = phrases.collocations(frame(spark, rows).withColumns({"row": F.lit(1), "n": F.lit("x"), "seed": F.lit(2)}),
                               max_words=max_words, how=phrases.Hashing(bits, block), top=25).collect()
    want = mined(rows, max_words, top=25)
    assert len(want) > 40 and len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_phrases_of_long_and_hot_texts(spark):
    rows = [r for r in ODD if r[0] in (905, 906)] + [(i, "one very common line", "en") for i in range(300)]
    rows += [(i, "A rare pair. a rare pair", "fr") for i in range(5)] + [(i, "too few words", "de") for i in range(9)]
    got = {tuple(r) for r in phrases.collocations(frame(spark, rows)).collect()}
    assert got == mined(rows)
    assert {g[2] for g in got if g[0] == "fr"} == {"a rare pair"} and not any(g[0] == "de" for g in got)


def test_no_phrases(spark):
    assert phrases.digest(frame(spark, [])).count() == 0
    assert phrases.digest(frame(spark, ODD[:3])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**13 + 7
    rows = [(big, big + 3, big + 5), (10, 10**13, 10**13), (10, 10, 10), (10**14 - 1, 10**14 - 1, 10**14 - 1)]
    got = spark.createDataFrame(rows, "a long, l long, r long").selectExpr("a", "l", "r", f"{phrases.SCORE} AS s")
    for r in got.collect():
        assert r["s"] == 1000000 * r["a"] ** 2 // (r["l"] * r["r"])
