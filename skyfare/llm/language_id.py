"""Language ID: the family first, then one-versus-one linear SVMs inside it.

Texts become hashed character 1- to 4-gram profiles of their letters. Families
are found from the training profiles: languages whose mean profiles are closest
are merged until about the square root of their number is left. Linear support
vector machines decide between the families pair by pair, and, within the
chosen family, between its languages pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from skyfare.llm.common import ROW, arrow_batch, discard, staged, tidy, unwrapped, wrapped

UNKNOWN = "und"
DIM = 4096
# About so many training texts in all, shared evenly by the languages, where
# what rare ones leave goes to the others; each has one at least. The choice is
# by a hash of the id. Bounds the model's cost, not its use.
MAX_TRAIN = 3000
HELD_OUT = 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Letters:
    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        return cls.table


def profile(text: str | None, dim: int = DIM) -> np.ndarray | None:
    """Unit vector of square-rooted hashed n-gram counts; None without letters.
    Everything but letters counts as one space between words."""
    if not text:
        return None
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = _Letters.get()[cp]
    if not alpha.any():
        return None
    kept = alpha.copy()
    kept[1:] |= alpha[:-1]  # the first non-letter after a letter is the space
    code = np.concatenate(([np.uint64(0)], np.where(alpha, cp, 0)[kept].astype(np.uint64), [np.uint64(0)]))
    out = np.zeros(dim)
    shift = np.uint64(64 - int(dim).bit_length() + 1)
    h = np.zeros(len(code), np.uint64)
    for n in range(4):
        h = (h[:len(code) - n] if n == 0 else h[:-1]) * _MIX + code[n:] + np.uint64(n + 1)
        out += np.bincount(((h * _MIX) >> shift).astype(np.int64), minlength=dim)
    out = np.sqrt(out)
    return out / np.sqrt(out @ out)


def _svm(x: np.ndarray, use: np.ndarray, y: np.ndarray, c: float = 10.0,
         epochs: int = 12) -> np.ndarray:
    """Linear SVM with squared hinge loss over the rows ``use`` of ``x`` by dual
    coordinate descent; the order of the coordinates is fixed by a seed. The
    last weight is the bias. Rows are read in place, not copied."""
    w, bias, alpha = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(len(use))
    q = np.einsum("ij,ij->i", x, x)[use] + 1 + 0.5 / c
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for k in rng.permutation(len(use)):
            row = x[use[k]]
            g = y[k] * (float(row @ w) + bias) - 1 + alpha[k] * 0.5 / c
            new = max(alpha[k] - g / q[k], 0.0)
            if new != alpha[k]:
                step = (new - alpha[k]) * y[k]
                w += np.float32(step) * row
                bias += step
                alpha[k] = new
    return np.append(w.astype(np.float64), bias)


@dataclass
class _Votes:
    """One-versus-one machines over some classes."""

    names: list
    pairs: list
    weights: np.ndarray

    def decide(self, v: np.ndarray) -> tuple[int, float]:
        """(class, 0 to 1): most pairwise wins, then the larger summed margin,
        then the first; the score is the mean of its pairwise probabilities."""
        k = len(self.names)
        if k == 1:
            return 0, 1.0
        p = 1 / (1 + np.exp(-4 * (self.weights[:, :-1] @ v + self.weights[:, -1])))
        wins, total = np.zeros(k), np.zeros(k)
        for (a, b), pa_ in zip(self.pairs, p):
            wins[a if pa_ >= 0.5 else b] += 1
            total[a] += pa_
            total[b] += 1 - pa_
        best = max(range(k), key=lambda i: (wins[i], total[i], -i))
        return best, float(total[best] / (k - 1))


@dataclass
class Model:
    families: list
    outer: _Votes | None
    inner: list

    def predict(self, v: np.ndarray | None) -> tuple[str, float]:
        if v is None or not self.families:
            return UNKNOWN, 0.0
        f, pf = self.outer.decide(v)
        i, pl = self.inner[f].decide(v)
        return self.families[f][i], pf * pl


def _families(means: np.ndarray, names: list) -> list[list[str]]:
    """Merge the two closest groups (mean cosine of their languages' mean
    profiles) until the square root of the number of languages is left."""
    groups = [[i] for i in range(len(names))]
    unit = means / np.sqrt((means * means).sum(axis=1, keepdims=True))
    sim = unit @ unit.T
    while len(groups) > max(1, int(np.ceil(np.sqrt(len(names))))):
        a, b = max(combinations(range(len(groups)), 2),
                   key=lambda ab: (sim[np.ix_(groups[ab[0]], groups[ab[1]])].mean(), -ab[0], -ab[1]))
        groups[a] += groups.pop(b)
    return [[names[i] for i in sorted(g)] for g in groups]


def _machines(families: list[list[str]]) -> dict[tuple, dict[str, float]]:
    """{(level, a, b): the side of each language that takes part}. Level -1
    decides between families, level f between the languages of family f."""
    levels = {-1: families} | {f: [[la] for la in g] for f, g in enumerate(families)}
    return {(level, a, b): {la: 1.0 if c == a else -1.0 for c in (a, b) for la in classes[c]}
            for level, classes in levels.items() for a, b in combinations(range(len(classes)), 2)}


def _model(families: list[list[str]], weights: dict[tuple, np.ndarray]) -> Model:
    def votes(level, names):
        pairs = [(a, b) for x, a, b in weights if x == level]
        return _Votes(names, pairs, np.array([weights[level, a, b] for a, b in pairs]))
    return Model(families, votes(-1, list(range(len(families)))), [votes(f, g) for f, g in enumerate(families)])


def fit(rows: list[tuple[str, np.ndarray]]) -> Model:
    """Model from profiles at hand; ``train`` gives the same from a table."""
    names = sorted({lang for lang, _ in rows})
    if not names:
        return Model([], None, [])
    x, lang = np.stack([v for _, v in rows]), np.array([la for la, _ in rows])
    families = _families(np.stack([x[lang == la].mean(axis=0) for la in names]), names)
    weights = {}
    for machine, side in _machines(families).items():
        use = np.flatnonzero(np.isin(lang, list(side)))
        weights[machine] = _svm(x, use, np.array([side[la] for la in lang[use]]))
    return _model(families, weights)


def _means(rows: DataFrame, dim: int) -> dict[str, np.ndarray]:
    """Mean profile of each language: summed in the tasks, a sum for each task
    and language on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, list] = {}
        for b in batches:
            for la, v in zip(b.column("l").to_pylist(), b.column("v").to_pylist()):
                n = total.setdefault(la, [0, np.zeros(dim)])
                n[0] += 1
                n[1] += np.frombuffer(v, np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([n for n, _ in total.values()], pa.int64()),
             pa.array([v.tobytes() for _, v in total.values()], pa.binary())], ["l", "n", "v"])

    sums: dict[str, list] = {}
    for r in rows.mapInArrow(run, "l string, n bigint, v binary").collect():
        n = sums.setdefault(r["l"], [0, np.zeros(dim)])
        n[0] += r["n"]
        n[1] += np.frombuffer(r["v"], np.float64)
    return {la: v / n for la, (n, v) in sums.items()}


def _train_machines(rows: DataFrame, families: list[list[str]], dim: int) -> dict[tuple, np.ndarray]:
    """Each machine in a task of its own, over the profiles of its languages
    (at most all training texts); the driver gets the weights."""
    machines = _machines(families)
    if not machines:
        return {}
    sides = F.broadcast(rows.sparkSession.createDataFrame(
        [(la, *m, s) for m, side in machines.items() for la, s in side.items()],
        "l string, level int, a int, b int, y double"))

    def run(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table.select(["l", "o"]), [("l", "ascending"), ("o", "ascending")]).to_numpy()
        x, at = np.empty((len(table), dim), np.float32), 0
        for chunk in table.column("v").chunks:
            for v in chunk:
                x[at] = np.frombuffer(v.as_buffer(), np.float32)
                at += 1
        # Rows stay where they are; the machine is told their order.
        w = _svm(x, order, table.column("y").to_numpy()[order])
        return pa.table({c: table.column(c).slice(0, 1) for c in ("level", "a", "b")}
                        | {"w": pa.array([w.tobytes()], pa.binary())})

    with arrow_batch(rows.sparkSession, 250):
        found = (rows.join(sides, "l").groupBy("level", "a", "b")
                 .applyInArrow(run, "level int, a int, b int, w binary").collect())
    got = {(r["level"], r["a"], r["b"]): np.frombuffer(r["w"], np.float64) for r in found}
    return {m: got[m] for m in machines}


def held_out_column(id_col):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == HELD_OUT


def _quota(counts: list[int], total: int) -> int:
    """The most texts a language may give, for ``total`` in all."""
    left = total
    for i, n in enumerate(sorted(counts)):
        share = left // (len(counts) - i)
        if n > share:
            return max(1, share)
        left -= n
    return max(counts)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train: int = MAX_TRAIN, dim: int = DIM) -> Model:
    """Model from the rows that are not held out and have a text and a language.

    Distinct texts are counted by language first; then the hashes under a bound
    that leaves a few more than wanted are ranked, ``max_train`` in all, or one
    a language if there are more. So a language's ranking reads about as many
    rows as it gives, however many there are. Profiles, their sums and the
    machines are made in the tasks; the driver receives sums and weights.
    """
    labelled = docs.filter(~held_out_column(id_col) & F.col(text_col).isNotNull()
                           & F.col(lang_col).isNotNull())
    order = F.xxhash64(F.col(id_col), F.col(text_col))
    hashes = staged(labelled.select(F.col(lang_col).alias("l"), order.alias("o")).distinct(), "lang-hashes")
    counted = staged(hashes.groupBy("l").agg(F.count("*").alias("n")), "lang-counts")
    counts = [r["n"] for r in counted.collect()]
    if not counts:
        return fit([])
    each = _quota(counts, max_train)
    # Of n hashes spread over 2**64, so many lie under the bound that with a
    # margin of ten deviations at least ``each`` do.
    share = F.least(F.lit(1.0), F.lit(each + 10.0 * each ** 0.5 + 100.0) / F.col("n"))
    # One row a language, which the driver has seen: small enough to send along.
    under = (hashes.join(F.broadcast(counted), "l").filter(F.col("o") <= -2.0**63 + share * 2.0**64).select("l", "o"))
    ranked = under.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("o")))
    chosen = F.broadcast(ranked.filter(F.col("r") <= each).select("l", "o"))
    texts = (labelled.select(F.col(lang_col).alias("l"), order.alias("o"), F.col(text_col).alias("t"))
             .join(chosen, ["l", "o"], "left_semi").dropDuplicates(["l", "o"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [profile(t.as_py(), dim) for t in b.column("t")]
            raw = [None if p is None else p.astype(np.float32).tobytes() for p in v]
            yield pa.RecordBatch.from_arrays([b.column("l"), b.column("o"), pa.array(raw, pa.binary())],
                                             ["l", "o", "v"])

    rows = staged(texts.mapInArrow(run, "l string, o bigint, v binary"), "lang-profiles")
    discard(hashes)
    tidy(docs.sparkSession)
    usable = rows.filter("v IS NOT NULL")
    means = _means(usable, dim)
    if not means:
        return fit([])
    families = _families(np.stack([means[la] for la in sorted(means)]), sorted(means))
    return _model(families, _train_machines(usable, families, dim))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_train: int = MAX_TRAIN, dim: int = DIM) -> DataFrame:
    """``docs`` plus held_out, lang_pred and score.

    - NULL text, or one without a letter: ``und`` with score 0; likewise every
      row if nothing can be learned.
    - A prediction depends on the text alone; repeated rows get one answer.
    - A NULL id has no remainder: it is neither held out (NULL) nor learned from.
    - Columns named like an added one are replaced, all others come through,
      whatever their names; an empty table stays empty.

    One pass over the texts, whole, without a shuffle; the model is broadcast,
    its size bounded by pairs of languages x ``dim``.
    """
    carry = [c for c in docs.columns if c.lower() not in ("held_out", "lang_pred", "score")]
    base = wrapped(docs, [c for c in carry if c != text_col], id=id_col, txt=text_col, lang=lang_col)
    model = docs.sparkSession.sparkContext.broadcast(train(base, "id", "txt", "lang", max_train, dim))
    rows = base.select(ROW, "txt", held_out_column("id").alias("held_out"))
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            said = [m.predict(profile(t.as_py(), dim)) for t in b.column("txt")]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([s[0] for s in said], pa.string()),
                 pa.array([s[1] for s in said], pa.float64())], schema.fieldNames())

    own = [F.col("txt").alias(c) if c == text_col else unwrapped([c])[0] for c in carry]
    return rows.mapInArrow(run, schema).select(*own, "held_out", "lang_pred", "score")


def digest(docs: DataFrame) -> DataFrame:
    return (identify(docs.select("doc_id", "text", "lang"))
            .select("doc_id", "held_out", "lang_pred", "score"))
