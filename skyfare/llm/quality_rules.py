"""Quality rules: base limits, then robust multivariate outliers.

Each text gives a vector of transformed statistics. For every (language,
source) a minimum-covariance-determinant estimate is made by concentration
steps from several starts: keep the ``KEEP_SHARE`` of the rows nearest to the
centre, take their mean and covariance, and repeat until no determinant falls
any more; the start that ends with the least determinant counts. One
reweighting step follows, and rows whose squared Mahalanobis distance exceeds
a chi-square cutoff are rejected.

All of it is column expressions and grouped aggregates. Statistics are fixed-
point integers, so sums are exact and do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from skyfare.llm.common import ROW, SPACE_CLASS, staged, tidy, unwrapped, wrapped

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_GROUP = 200
KEEP_SHARE = 0.75
# Steps end when no determinant falls by a thousandth any more, or after so many.
SETTLED, MAX_STEPS = 1e-3, 30
# Squared Mahalanobis distance past which a row is an outlier: the chi-square
# of five statistics that one row in ten million of a normal passes. Real
# statistics have heavier tails, and clean rows are to stay.
CUTOFF = 40.86
# Consistency of the covariance of the nearest 75 % and 97.5 % of a 5-variate
# normal, and the distance that holds 97.5 %.
CONSISTENCY, CONSISTENCY_REWEIGHTED, REWEIGHT_AT = 1.41, 1.056, 12.83

# Each statistic and its resolution, the least standard deviation: about half of
# what the smallest change (a symbol, a repeated line, a repeated window) makes
# of it in a text of a hundred words or so. Most texts have none of the last
# three, so that the nearest 75 % may have no spread at all.
FEATURES = {
    "x1": ("ln(n_words)", 0.05),
    "x2": ("ln((word_chars + 100.0D) / (n_words + 20))", 0.01),
    "x3": ("n_symbols / word_chars", 0.01),
    "x4": ("ln(1 + n_dup_lines)", 0.35),
    "x5": ("n_repeat_words / n_words", 0.02),
}
# Statistics are integers, so many units to a resolution: sums are exact and
# exact percentiles hold a bounded number of distinct values.
UNIT = 20
BIN = 200
X = tuple(FEATURES)
PAIRS = tuple((i, j) for i in range(len(X)) for j in range(i + 1))
# Starts of the concentration: medians and spreads; the same, looking at the
# first two statistics only; mean and covariance of all rows.
STARTS = 3


def _word_list(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", -1), lambda w: w != "")


def base_columns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long) and base_failed. A NULL text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    word_hash = F.transform(_word_list(F.col(text_col)), lambda w: F.xxhash64(w))
    at = lambda i: F.get(F.col("_w"), i)
    windows = F.when(F.size("_w") > WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_w") - WINDOW),
        lambda i: F.xxhash64(*[at(i + k) for k in range(WINDOW)])))
    repeats = F.col("_h").isNotNull() & (F.size(F.array_distinct("_h")) < F.size("_h"))
    twin = lambda w, i: F.coalesce(F.when(i >= 0, F.get(F.col("_p"), i)["h"]) == w["h"], F.lit(False))
    gaps = F.zip_with(F.slice(F.col("_s"), 2, F.size("_s")),
                      F.slice(F.col("_s"), 1, F.size("_s") - 1),
                      lambda b, a: F.least(b - a, F.lit(WINDOW)))
    return (docs
            .withColumns({
                "word_chars": F.char_length(F.regexp_replace(text, f"[{SPACE_CLASS}]+", "")).cast("long"),
                "n_symbols": F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
                "_lines": lines, "_w": word_hash})
            .withColumns({
                "n_words": F.size("_w").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "_h": windows})
            # Only texts with a repeated window pay for the sort.
            .withColumn("_p", F.when(repeats, F.array_sort(F.transform(
                "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
            .withColumn("_s", F.array_sort(F.transform(
                F.filter("_p", lambda w, i: twin(w, i - 1) | twin(w, i + 1)), lambda w: w["i"])))
            # Windows found twice: the union of [start, start + 5).
            .withColumn("n_repeat_words", F.when(F.col("_s").isNull(), F.lit(0)).otherwise(
                WINDOW + F.aggregate(gaps, F.lit(0), lambda x, y: x + y)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .drop("_lines", "_w", "_h", "_p", "_s"))


def _inverse(cov: Column) -> Column:
    """(inv, det) of a positive definite matrix held row by row in a flat
    array: sweeping every pivot gives minus the inverse, and the pivots'
    product is the determinant."""
    p = len(X)

    def sweep(acc, k):
        m = acc["m"]
        pivot = F.get(m, k * p + k)

        def cell(v, q):
            i, j = F.floor(q / p).cast("int"), q % p
            return (F.when((i == k) & (j == k), -1.0 / pivot)
                    .when((i == k) | (j == k), v / pivot)
                    .otherwise(v - F.get(m, i * p + k) * F.get(m, k * p + j) / pivot))
        return F.struct(F.transform(m, cell).alias("m"), (acc["det"] + F.log(pivot)).alias("det"))

    start = F.struct(cov.alias("m"), F.lit(0.0).alias("det"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), start, sweep, lambda acc: F.struct(
        F.transform(acc["m"], lambda v: -v).alias("inv"), acc["det"].alias("logdet")))


def _distance2() -> Column:
    z = [F.col(x) - F.get("m", F.lit(i)) for i, x in enumerate(X)]
    d2 = F.lit(0.0)
    for i, j in PAIRS:
        d2 = d2 + (1 if i == j else 2) * z[i] * z[j] * F.get("inv", F.lit(i * len(X) + j))
    return d2


def _groups(rows: DataFrame, min_group: int) -> DataFrame:
    """(lang, source, grp): the pair itself if it has ``min_group`` rows, else
    all such small sources of the language, else everything that is left. NULLs
    are written out in a group's name, so none is taken for a pooled one."""
    def named(*cols):
        return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    n = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < min_group
    pooled = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang"))
    return (n.withColumn("pooled", pooled)
            .select("lang", "source", F.when(~small, named("lang", "source"))
                    .when(F.col("pooled") >= min_group, named("lang"))
                    .otherwise("*").alias("grp")))


def _sums() -> list[Column]:
    """What a mean and a covariance are made of."""
    sums = [F.count("*").alias("n")] + [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)]
    return sums + [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in PAIRS]


def _fitted(sums: DataFrame, scale: float) -> DataFrame:
    """grp, start, m, inv, logdet: the mean, and the inverse and determinant of
    the covariance times ``scale`` with its diagonal floored."""
    n = F.col("n").cast("double")

    def cov(i, j):
        c = scale * (F.col(f"s{max(i, j)}_{min(i, j)}") / n - F.col(f"s{i}") / n * (F.col(f"s{j}") / n))
        return F.greatest(c, F.lit(float(UNIT * UNIT))) if i == j else c
    p = range(len(X))
    return (sums.select("grp", "start", F.array(*[F.col(f"s{i}") / n for i in p]).alias("m"),
                        _inverse(F.array(*[cov(i, j) for i in p for j in p])).alias("c"))
            .select("grp", "start", "m", "c.inv", "c.logdet"))


def _distances(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Each row once for every state of its group, with its distance."""
    packed = states.groupBy("grp").agg(F.collect_list(F.struct("start", "m", "inv")).alias("states"))
    return rows.join(packed, "grp").select("grp", *X, F.inline("states")).withColumn("d2", _distance2())


def _nearest(rows: DataFrame, states: DataFrame, share: float) -> DataFrame:
    """Sums over the ``share`` of each group's rows with the least distance, for
    each start. Sums are made by distance bin first, so one pass finds the limit
    and what lies within it; bins are a few thousand a group at any size."""
    bin_ = F.round(BIN * F.log(F.greatest("d2", F.lit(0.0)) + 0.01)).cast("long").alias("bin")
    bins = _distances(rows, states).groupBy("grp", "start", bin_).agg(*_sums())
    upto = Window.partitionBy("grp", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("grp", "start")
    # The bin that holds the row at this share, and all before it.
    inside = (bins.withColumn("before", F.sum("n").over(upto) - F.col("n"))
              .withColumn("last", F.floor(F.lit(share) * (F.sum("n").over(whole) - 1)))
              .filter(F.col("before") <= F.col("last")).drop("before", "last", "bin"))
    names = [c for c in inside.columns if c not in ("grp", "start")]
    return inside.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in names])


def _step(rows: DataFrame, states: DataFrame, name: str) -> tuple[DataFrame, int]:
    """One concentration step, written: every start that still moves is fitted
    to its nearest rows, and moves on if its determinant falls. Also how many
    starts go on."""
    going = states.filter("going")
    fitted = _fitted(_nearest(rows, going, KEEP_SHARE), CONSISTENCY)
    now = states.join(fitted.select("grp", "start", *[F.col(c).alias(f"_{c}") for c in ("m", "inv", "logdet")]),
                      ["grp", "start"], "left")
    fell = F.coalesce(F.col("_logdet") < F.col("logdet") - SETTLED, F.lit(False))
    seen = Observation()
    out = now.select("grp", "start", *[F.when(fell, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
                                       for c in ("m", "inv", "logdet")], fell.alias("going"))
    written = staged(out.observe(seen, F.count_if("going").alias("n")), name)
    return written, seen.get["n"]


def _start(rows: DataFrame) -> DataFrame:
    """The states to begin with, ``STARTS`` a group."""
    n = range(len(X))
    med = staged(rows.groupBy("grp").agg(*[F.percentile(x, F.lit(0.5)).alias(f"m{i}")
                                           for i, x in enumerate(X)]), "mcd-medians")
    mad = staged(rows.join(med, "grp").groupBy("grp").agg(*[
        F.percentile(F.abs(F.col(x) - F.col(f"m{i}")), F.lit(0.5)).alias(f"a{i}")
        for i, x in enumerate(X)]), "mcd-spreads")
    variance = [F.greatest(2.2 * F.col(f"a{i}") * F.col(f"a{i}"), F.lit(float(UNIT * UNIT))) for i in n]

    def diagonal(start, looks_at):
        cells = [(1.0 if i in looks_at else 1e-6) / variance[i] if i == j else F.lit(0.0) for i in n for j in n]
        return F.struct(F.lit(start).alias("start"), F.array(*cells).alias("inv"))
    around = (med.join(mad, "grp").withColumn("m", F.array(*[F.col(f"m{i}") for i in n]))
              .select("grp", "m", F.inline(F.array(diagonal(0, n), diagonal(1, (0, 1)))))
              .select("grp", "start", "m", "inv"))
    plain = _fitted(rows.withColumn("start", F.lit(2)).groupBy("grp", "start").agg(*_sums()), 1.0)
    # No covariance stands behind a diagonal start, so its first step always counts.
    return staged(around.withColumn("logdet", F.lit(float("inf"))).union(plain).withColumn("going", F.lit(True)),
                  "mcd-start")


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", min_group: int = MIN_GROUP,
                  cutoff: float = CUTOFF, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or only its columns ``carry``) plus the base columns,
    ``distance2`` and ``kept``.

    - NULL or empty text: no words, so base_failed and not kept.
    - NULL language or source: a group of its own.
    - A group of under ``min_group`` rows joins the small sources of its
      language, then all that is left; equal vectors fall together.
    - An empty table gives an empty result. Input columns named like an added
      one are replaced; all others come through, whatever their names.

    The only shuffles are of the integer statistics (five longs a row) and,
    pre-aggregated, of one line a group. The text is read once and not moved.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "distance2", "kept"]
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in added]
    # Written once: a filter on these columns would otherwise be pushed below
    # them and evaluate the statistics of each text again and again.
    base = staged(base_columns(wrapped(docs, carry, txt=text_col, lang=lang_col, source=source_col), "txt")
                  .drop("txt"), "quality-base")
    groups, state = estimate(base.drop(ROW), min_group)
    # A row's verdict is a function of its group and statistics: attach the
    # group and its estimate, and compute the distance in place.
    out = base.join(groups.withColumnsRenamed({"lang": "_l", "source": "_s"}),
                    F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    out = _statistics(out).join(state, "grp", "left").withColumn("d2", _distance2())
    d2 = F.when(~F.col("base_failed"), F.col("d2"))
    return (out.withColumn("distance2", d2)
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(True)))
            .select(*unwrapped(carry), *added))


def _statistics(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        x: F.expr(f"CASE WHEN NOT base_failed THEN CAST(round(({sql}) * {UNIT} / {floor}) AS BIGINT) END")
        for x, (sql, floor) in FEATURES.items()})


def estimate(base: DataFrame, min_group: int = MIN_GROUP) -> tuple[DataFrame, DataFrame]:
    """(groups, state): the group of each (lang, source), and the final centre
    and covariance factors of each group, from the rows that pass the base rules."""
    passed = base.filter(~F.col("base_failed"))
    groups = staged(_groups(passed, min_group), "mcd-groups")
    # Written with their group: every pass below would join it again.
    rows = staged(_statistics(passed).join(
        groups.withColumnsRenamed({"lang": "_l", "source": "_s"}),
        F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")))
        .select("grp", *X), "mcd-rows")
    states = _start(rows)
    for step in range(MAX_STEPS):
        states, going = _step(rows, states, f"mcd-step{step}")
        if not going:
            break
    least = states.groupBy("grp").agg(F.min_by(F.struct("start", "m", "inv"), F.struct("logdet", "start")).alias("b"))
    near = _distances(rows, least.select("grp", "b.*")).filter(F.col("d2") <= REWEIGHT_AT)
    final = _fitted(near.groupBy("grp", "start").agg(*_sums()), CONSISTENCY_REWEIGHTED)
    final = staged(final.select("grp", "m", "inv"), "mcd-final")
    tidy(base.sparkSession)
    return groups, final


def digest(docs: DataFrame) -> DataFrame:
    return quality_rules(docs.select("doc_id", "text", "lang", "source"),
                         carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
