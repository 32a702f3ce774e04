"""Chat formatting by quotation linking.

Lines that open with ``>`` marks are quotes; the number of marks is their
level. A run of lines of one level is a passage. Its hash, after normalising,
is looked up among the passages of earlier messages of the conversation, and
among their runs of as many lines, which links a message to the one it answers.
Messages are then put in reply order, and formatted without their quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.llm.common import SPACE_CLASS, ascii_lower, discard, staged

MARKS = r"^[\x20\x09]*((?:>[\x20\x09]*)+)"


def _passage_key(text: Column) -> Column:
    """White space as single spaces, none outside, A-Z lower-cased."""
    return ascii_lower(F.btrim(F.regexp_replace(text, f"[{SPACE_CLASS}]+", " ")))


def _lines(text: Column) -> Column:
    """(level, body, pos) of each line; level 0 is the message's own text."""
    def part(line, i):
        marks = F.regexp_extract(line, MARKS, 1)
        level = F.char_length(F.regexp_replace(marks, r"[^>]", ""))
        return F.struct(level.alias("level"), F.regexp_replace(line, MARKS, "").alias("body"), i.alias("pos"))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), part)


def _line_hashes(text: Column) -> Column:
    """Two hashes of each line that is not blank, normalised."""
    keys = F.filter(F.transform(F.split(text, "\n", -1), _passage_key), lambda k: k != "")
    return F.transform(keys, lambda k: F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b")))


def _ladder(hashes: Column) -> Column:
    """The hashes of all runs of 1, 2, 4, ... lines: rung k holds, by their
    first line, those of 2^k lines, each made of two of the rung below."""
    def joined(x: Column, y: Column) -> Column:
        return F.struct(F.xxhash64(x["a"], y["a"]).alias("a"), F.xxhash64(F.lit(1), x["b"], y["b"]).alias("b"))

    def climb(rungs: Column, k: Column) -> Column:
        low, half = F.element_at(rungs, -1), F.call_function("shiftleft", F.lit(1), k - F.lit(1))
        ahead = F.slice(low, half + F.lit(1), F.size(low))
        return F.array_append(rungs, F.zip_with(F.slice(low, F.lit(1), F.size(ahead)), ahead, joined))
    return F.aggregate(F.filter(F.sequence(F.lit(0), _rung(F.size(hashes))), lambda k: k > 0),
                       F.array(hashes), climb)


def _rung(lines: Column) -> Column:
    """The largest k with 2^k lines or fewer."""
    return F.length(F.bin(lines.cast("long"))) - F.lit(1)


def _text_key(key: Column) -> Column:
    return F.struct(F.lit("text").alias("kind"), F.xxhash64(key).alias("k1"),
                    F.xxhash64(F.lit(1), key).alias("k2"))


def _run_key(lines: Column, head: Column, tail: Column) -> Column:
    """Key of a run of lines: their number and the hashes of its first and last
    2^k lines, k as large as can be. The two overlap and cover the run, so runs
    of one length are equal exactly where both are."""
    return F.struct(F.lit("lines").alias("kind"), F.xxhash64(lines, head["a"], tail["a"]).alias("k1"),
                    F.xxhash64(F.lit(1), lines, head["b"], tail["b"]).alias("k2"))


def _ends(runs: DataFrame) -> DataFrame:
    """``runs`` with lines (hs) plus m, k, head and tail of the whole run."""
    rungs = runs.filter(F.size("hs") > 0).withColumn("rungs", _ladder(F.col("hs"))).withColumn(
        "m", F.size("hs")).withColumn("k", _rung(F.col("m")))
    top = F.element_at("rungs", -1)
    return (rungs.withColumns({"head": F.get(top, F.lit(0)), "tail": F.element_at(top, -1)})
            .drop("rungs", "hs"))


def _line_runs(streams: DataFrame, passages: DataFrame) -> DataFrame:
    """(conv, turn, key): the runs of lines in ``streams`` (conv, turn, hs) that
    equal a passage (conv, m, k, head, tail). Every place of a stream carries
    its hashes of 2^k lines, for the k of its conversation's passages; they meet
    the heads of passages, and what then has the tail at its place is a run.
    Rows of a few numbers only: no run is hashed as a whole, and a stream of n
    lines makes at most n log n of them."""
    sought = passages.select("conv", "m", "k", "head", "tail").distinct()
    rungs = passages.groupBy("conv").agg(F.array_sort(F.collect_set("k")).alias("ks"))
    places = staged(
        streams.filter(F.size("hs") > 0).join(rungs, "conv")
        .withColumn("stream", F.monotonically_increasing_id())
        .withColumn("rungs", _ladder(F.col("hs")))
        .withColumn("k", F.explode(F.filter("ks", lambda k: k < F.size("rungs"))))
        .select("conv", "turn", "stream", "k", F.posexplode(F.get("rungs", F.col("k"))).alias("i", "h")), "line-places")
    met = places.join(sought.withColumn("h", F.col("head")), ["conv", "k", "h"])
    short = met.filter("head = tail AND m = shiftleft(1, k)")
    tails = places.select("stream", "k", F.col("i").alias("at"), F.col("h").alias("tail"))
    long = (met.filter("m > shiftleft(1, k)").withColumn("at", F.expr("i + m - shiftleft(1, k)"))
            .join(tails, ["stream", "k", "at", "tail"]))
    key = _run_key(F.col("m"), F.col("head"), F.col("tail")).alias("key")
    return short.select("conv", "turn", key).union(long.select("conv", "turn", key)).distinct()


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv, turn, role, copy, body, n_quote_lines, max_level,
    n_linked, parent_turn, position.

    - ``body`` is the message without quoted lines, outer white space stripped.
    - A passage of level L, with L - 1 marks taken off, is held against every
      passage (a run of lines of one level), every whole own text, every
      paragraph of one and every run of as many lines, blank ones aside, of
      either, of earlier turns; the latest turn with an equal one is its origin.
      Whole passages, texts and paragraphs may be wrapped otherwise, runs of
      lines may not; a part of a line is no quote of it. ``parent_turn`` is
      the origin of the outermost linked passage, the latest if several; without
      any, the turn before; NULL for the first turn.
    - ``position`` counts from 0 in reply order: each message follows its parent,
      replies to one message by turn. Parents are earlier turns, so the order by
      (path of parents) is that of a tree walk.
    - NULL text is an empty message. NULL conversation or turn: no links, no
      position. Messages of one turn are numbered by ``copy`` (0, 1, ...) in
      order of role and text, and are ordered by it.
    - Other columns are not carried; an empty table gives an empty result.

    Only line and passage hashes are shuffled for the links. Message keys, not
    texts, are sorted for the order, by ranges: no task has to hold a conversation.
    """
    rows = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                           F.col(role).alias("role"), F.col(text).alias("text"))
    rows = _copies(rows).withColumn("lines", _lines(F.col("text")))
    own = F.filter("lines", lambda x: x["level"] == 0)
    quoted = F.filter("lines", lambda x: x["level"] > 0)
    rows = rows.withColumns({
        "body": F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"),
                                 f"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", ""),
        "n_quote_lines": F.size(quoted).cast("long"),
        "max_level": F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0))})
    rows = staged(rows.select("conv", "turn", "role", "copy", "body", "n_quote_lines", "max_level",
                              F.when(F.col("n_quote_lines") > 0, F.col("lines")).alias("lines")),
                  "messages")
    # Passages: runs of lines of one level within a message.
    known = rows.filter("conv IS NOT NULL AND turn IS NOT NULL")
    line = (known.filter("lines IS NOT NULL").select("conv", "turn", "copy", F.explode("lines").alias("x"))
            .select("conv", "turn", "copy", "x.*"))
    one = Window.partitionBy("conv", "turn", "copy").orderBy("pos")
    runs = (line.withColumn("new", F.coalesce(F.col("level") != F.lag("level").over(one), F.lit(True)))
            .withColumn("run", F.sum(F.col("new").cast("int")).over(one))
            .groupBy("conv", "turn", "copy", "run", "level")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))),
                                          lambda x: x["body"]), "\n").alias("p"))
            .withColumn("key", _passage_key(F.col("p"))).filter("key != ''"))
    runs = staged(runs.select("conv", "turn", "copy", "run", "level", _text_key(F.col("key")).alias("key"),
                              _line_hashes(F.col("p")).alias("hs")), "passages")
    quoted_runs = runs.filter("level > 0")
    passages = staged(_ends(quoted_runs), "passage-ends")
    quoting = quoted_runs.select("conv").distinct()
    # Own texts of a quoting conversation, whole and by paragraph.
    texts = rows.join(quoting, "conv", "left_semi").select("conv", "turn", "body")
    keys = F.transform(F.array_append(F.split("body", f"\n[{SPACE_CLASS}]*\n", -1), F.col("body")), _passage_key)
    whole = texts.select("conv", "turn", F.explode(F.array_distinct(F.transform(
        F.filter(keys, lambda k: k != ""), _text_key))).alias("key"))
    streams = (texts.select("conv", "turn", _line_hashes(F.col("body")).alias("hs"))
               .union(quoted_runs.select("conv", "turn", "hs")))
    sources = (whole.union(runs.select("conv", "turn", "key")).union(_line_runs(streams, passages))
               .distinct().withColumnRenamed("turn", "from_turn"))
    # The latest earlier turn with the passage, of each quoted passage.
    by_lines = _run_key(F.col("m"), F.col("head"), F.col("tail"))
    sought = passages.select("conv", "turn", "copy", "run", "level",
                             F.explode(F.array(F.col("key"), by_lines)).alias("key"))
    origin = (_latest_before(sought, sources, ["conv", "key"])
              .groupBy("conv", "turn", "copy", "run", "level").agg(F.max("from_turn").alias("origin")))
    linked = (origin.groupBy("conv", "turn", "copy").agg(
        F.count("*").alias("n_linked"), F.min_by("origin", F.struct("level", -F.col("origin"))).alias("linked")))
    placed = _reply_order(known.select("conv", "turn", "copy"), staged(linked, "links"))
    return (rows.drop("lines").join(placed, ["conv", "turn", "copy"], "left")
            .select(F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role),
                    "copy", "body", "n_quote_lines", "max_level",
                    F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent_turn",
                    F.col("position").cast("long").alias("position")))


def _dealt(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` written in ranges of ``order``, numbered by ``part``."""
    return staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)


def _carried(dealt: DataFrame, group: list[str], name: str, **totals) -> DataFrame:
    """``dealt`` plus each of ``totals`` (name=(F.sum or F.max, column)) over the
    earlier ranges of a row's group. A range has at most one group that began
    before it, so one line a range is broadcast."""
    sizes = staged(dealt.groupBy(*group, "part").agg(*[f(c).alias(k) for k, (f, c) in totals.items()]),
                   f"{name}-sizes")
    spans = sizes.groupBy(*group).agg(F.count("*").alias("n")).filter("n > 1").select(*group)
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = staged(sizes.join(F.broadcast(spans), group, "left_semi").select(
        *group, "part", *[f(k).over(earlier).alias(k) for k, (f, _) in totals.items()]), f"{name}-carry")
    return dealt.join(F.broadcast(carry), [*group, "part"], "left")


def _copies(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``copy``, the number of each among those of its turn. Only
    messages whose turn has others are sorted, by ranges; the sort samples a
    hundred of their texts a task for the driver."""
    rows = rows.withColumn("g", F.struct("conv", "turn"))  # equal where both are NULL
    shared = staged(rows.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g"), "shared-turns")
    if not shared.limit(1).count():
        return rows.drop("g").withColumn("copy", F.lit(0))
    alone = rows.join(shared, "g", "left_anti").drop("g").withColumn("copy", F.lit(0))
    dealt = _dealt(rows.join(shared, "g", "left_semi").withColumn("salt", F.monotonically_increasing_id()),
                   ["conv", "turn", "role", "text", "salt"], "copies")
    order = Window.partitionBy("part", "g").orderBy(F.col("role").asc_nulls_first(),
                                                    F.col("text").asc_nulls_first())
    dealt = _carried(dealt, ["g"], "copies", before=(F.sum, F.lit(1)))
    copy = F.coalesce("before", F.lit(0)) + F.row_number().over(order) - 1
    return alone.unionByName(dealt.withColumn("copy", copy.cast("int")).select(alone.columns))


def _latest_before(sought: DataFrame, sources: DataFrame, group: list[str]) -> DataFrame:
    """``sought`` plus ``from_turn``, the latest turn before its own that
    ``sources`` have with the same ``group``; rows without one go. What is
    sought and found is sorted together, not paired."""
    both = (sought.unionByName(sources.withColumn("turn", F.col("from_turn")), allowMissingColumns=True)
            # Behind what is sought by the same turn.
            .withColumn("side", F.col("from_turn").isNotNull())
            .withColumn("salt", F.monotonically_increasing_id()))
    dealt = _dealt(both, [*group, "turn", "side", "salt"], "sought")
    dealt = _carried(dealt, group, "sought", before=(F.max, F.col("from_turn")))
    so_far = (Window.partitionBy("part", *group).orderBy("turn", "side")
              .rowsBetween(Window.unboundedPreceding, 0))
    return (dealt.withColumn("latest", F.coalesce(F.max("from_turn").over(so_far), "before"))
            .filter(~F.col("side") & F.col("latest").isNotNull())
            .select(*sought.columns, F.col("latest").alias("from_turn")))


def _reply_order(messages: DataFrame, linked: DataFrame) -> DataFrame:
    """``messages`` (conv, turn, copy) with n_linked, parent_turn and their place
    in a walk of the reply tree. Where each message answers the turn before,
    that is the order of turns, summed up by ranges."""
    turns = _dealt(messages.groupBy("conv", "turn").agg(F.count("*").alias("copies")), ["conv", "turn"], "turns")
    turns = _carried(turns, ["conv"], "turns", last=(F.max, F.col("turn")), carried=(F.sum, F.col("copies")))
    one = Window.partitionBy("part", "conv").orderBy("turn")
    first = linked.groupBy("conv", "turn").agg(F.min("linked").alias("first"))
    turns = staged(turns.select(
        "conv", "turn", "copies", F.coalesce(F.lag("turn").over(one), "last").alias("prior"),
        (F.coalesce("carried", F.lit(0)) + F.sum("copies").over(one) - F.col("copies")).alias("at"))
        .join(first, ["conv", "turn"], "left").withColumn("up", F.coalesce("first", "prior")).drop("first"),
        "reply-turns")
    branching = staged(turns.filter("up != prior").select("conv").distinct(), "branching")
    if branching.limit(1).count():
        walked = _walk(turns.join(branching, "conv", "left_semi").select("conv", "turn", "up", "copies"))
        turns = turns.join(walked, ["conv", "turn"], "left").withColumn("at", F.coalesce("walk_at", "at"))
    return (messages.join(turns.select("conv", "turn", "prior", "at"), ["conv", "turn"])
            .join(linked, ["conv", "turn", "copy"], "left")
            .select("conv", "turn", "copy", "n_linked", F.coalesce("linked", "prior").alias("parent_turn"),
                    (F.col("at") + F.col("copy")).alias("position")))


def _walk(tree: DataFrame) -> DataFrame:
    """conv, turn, walk_at: the messages before each turn in a walk of the tree.

    The walk is a list: a turn is entered (side 0) after its parent is entered
    or the reply before it is left, and left (side 1) after its last reply is
    left, or at once. Sums along the list are doubled: each round doubles the
    steps that the sum of an element spans, so rounds grow with the logarithm
    of a conversation. An element follows one other and is followed by one, so
    no round has a hot key, and each holds a few numbers."""
    replies = _dealt(tree, ["conv", "up", "turn"], "replies")
    replies = _carried(replies.filter("up IS NOT NULL"), ["conv", "up"], "replies", last=(F.max, F.col("turn")))
    side_by_side = Window.partitionBy("part", "conv", "up").orderBy("turn")
    enter = (replies.withColumn("sibling", F.coalesce(F.lag("turn").over(side_by_side), "last"))
             .select("conv", "turn", F.lit(0).alias("side"), F.coalesce("sibling", "up").alias("to_turn"),
                     F.col("sibling").isNotNull().cast("int").alias("to_side"), "copies"))
    root = tree.filter("up IS NULL").select("conv", "turn", F.lit(0).alias("side"), F.col("up").alias("to_turn"),
                                            F.lit(0).alias("to_side"), "copies")
    last = (tree.filter("up IS NOT NULL").groupBy("conv", F.col("up").alias("turn"))
            .agg(F.max("turn").alias("reply")))
    leave = tree.join(last, ["conv", "turn"], "left").select(
        "conv", "turn", F.lit(1).alias("side"), F.coalesce("reply", "turn").alias("to_turn"),
        F.col("reply").isNotNull().cast("int").alias("to_side"), F.lit(0).cast("long").alias("copies"))
    state = staged(root.union(enter).union(leave).withColumnRenamed("copies", "total"), "walk0")
    k = 0
    while state.filter("to_turn IS NOT NULL").limit(1).count():
        k += 1
        before = state.select("conv", F.col("turn").alias("to_turn"), F.col("side").alias("to_side"),
                              F.col("to_turn").alias("turn2"), F.col("to_side").alias("side2"),
                              F.col("total").alias("total2"))
        longer = (state.filter("to_turn IS NOT NULL").join(before, ["conv", "to_turn", "to_side"])
                  .select("conv", "turn", "side", F.col("turn2").alias("to_turn"),
                          F.col("side2").alias("to_side"), (F.col("total") + F.col("total2")).alias("total")))
        spent, state = state, staged(state.filter("to_turn IS NULL").unionByName(longer), f"walk{k}")
        discard(spent)
    return (state.filter("side = 0").join(tree, ["conv", "turn"])
            .select("conv", "turn", (F.col("total") - F.col("copies")).alias("walk_at")))


def format_chat(linked: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv, chat: each conversation in reply order as ``role: body`` lines. A
    chat is one value, so one task puts it together."""
    line = F.concat(F.coalesce("role", F.lit("unknown")), F.lit(": "), "body")
    return (linked.filter(F.col("position").isNotNull()).groupBy(conv)
            .agg(F.array_sort(F.collect_list(F.struct("position", line.alias("x")))).alias("m"))
            .select(conv, F.array_join(F.transform("m", lambda r: r["x"]), "\n").alias("chat")))


def digest(messages: DataFrame) -> DataFrame:
    return link_quotes(messages).select(
        "conv_id", "turn", "role", "copy", "n_quote_lines", "max_level", "n_linked", "parent_turn",
        "position", F.sha2("body", 256).alias("body_sha256"))


# The levels, passages and reply order in SQL, by other means: a recursive
# walk for the order, lateral lines for the passages.
ORACLE_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id AS conv, turn, role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 AS copy
  FROM conversations),
l AS (
  SELECT conv, turn, copy, i, regexp_extract(line, '^[ \t]*((?:>[ \t]*)+)', 1) AS marks,
         regexp_replace(line, '^[ \t]*((?:>[ \t]*)+)', '') AS body
  FROM (SELECT conv, turn, copy, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m)),
v AS (SELECT *, length(marks) - length(replace(marks, '>', '')) AS level FROM l),
b AS (
  SELECT conv, turn, copy, count(*) FILTER (WHERE level > 0) AS n_quote_lines, max(level) AS max_level,
         trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (WHERE level = 0), ''),
              chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS body
  FROM v GROUP BY ALL),
r AS (
  SELECT conv, turn, copy, level, run, string_agg(body, chr(10) ORDER BY i) AS p
  FROM (SELECT *, i - row_number() OVER (PARTITION BY conv, turn, copy, level ORDER BY i) AS run FROM v)
  GROUP BY ALL),
k AS (
  SELECT *, trim(translate(regexp_replace(p, '[\x20\x09-\x0D]+', ' ', 'g'),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS key FROM r),
w AS (
  SELECT conv, turn, key FROM k JOIN b USING (conv, turn, copy) WHERE n_quote_lines > 0
  UNION SELECT conv, turn, trim(translate(regexp_replace(part, '[\x20\x09-\x0D]+', ' ', 'g'),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
  FROM (SELECT conv, turn, unnest(list_append(regexp_split_to_array(
          body, '\n[\x20\x09-\x0D]*\n'), body)) AS part FROM b)),
-- Lines that are not blank, normalised, each between line feeds: a run of whole
-- lines is a substring.
n AS (
  SELECT kind, conv, turn, copy, level, run, chr(10) || array_to_string(list_filter(list_transform(
           string_split(p, chr(10)), lambda y: trim(translate(regexp_replace(y, '[\x20\x09-\x0D]+', ' ', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))), lambda y: y != ''), chr(10))
         || chr(10) AS s
  FROM (SELECT 'quote' AS kind, conv, turn, copy, level, run, p FROM k WHERE level > 0 AND key != ''
        UNION ALL SELECT 'own', conv, turn, copy, 0, 0, body FROM b)),
f AS (
  SELECT k.conv, k.turn, copy, k.level, k.run, w.turn AS origin
  FROM k JOIN w ON k.conv = w.conv AND k.key = w.key AND w.turn < k.turn
  WHERE level > 0 AND k.key != ''
  UNION SELECT n.conv, n.turn, n.copy, n.level, n.run, x.turn
  FROM n JOIN n AS x ON n.conv = x.conv AND x.turn < n.turn AND contains(x.s, n.s)
  WHERE n.kind = 'quote'),
o AS (SELECT conv, turn, copy, level, run, max(origin) AS origin FROM f GROUP BY ALL),
q AS (
  SELECT b.conv, b.turn, b.copy, n_quote_lines, max_level, body, count(o.origin) AS n_linked,
         arg_min(o.origin, o.level * 1000000 - o.origin) AS linked
  FROM b LEFT JOIN o USING (conv, turn, copy) GROUP BY ALL),
e AS (
  SELECT conv, turn, lag(turn) OVER (PARTITION BY conv ORDER BY turn) AS prior
  FROM (SELECT DISTINCT conv, turn FROM m)),
p AS (SELECT q.*, coalesce(linked, prior) AS parent_turn FROM q JOIN e USING (conv, turn)),
t AS (SELECT conv, turn, min(parent_turn) AS up FROM p GROUP BY ALL),
walk AS (
  SELECT conv, turn, [turn] AS path FROM t WHERE up IS NULL
  UNION ALL SELECT t.conv, t.turn, list_append(walk.path, t.turn)
  FROM t JOIN walk ON t.conv = walk.conv AND t.up = walk.turn)
SELECT p.conv AS conv_id, p.turn, m.role, p.copy, n_quote_lines, max_level, n_linked, parent_turn,
       row_number() OVER (PARTITION BY p.conv ORDER BY path, p.copy) - 1 AS position,
       sha256(body) AS body_sha256
FROM p JOIN walk USING (conv, turn) JOIN m USING (conv, turn, copy)
"""
