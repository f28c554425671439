"""Quotation linking: from messages that quote others to reply-ordered conversations without quotes.

A message's lines are parsed into quote levels by their ``>`` marks. Lines of one
level that follow each other without a blank one make a quoted passage; it is
normalised as a whole (A-Z lower-cased, white space and line breaks become one
space), so wrapping does not matter, and hashed. Its original is the latest
earlier message of the conversation whose own text holds the whole passage. A
message replies to the original of most of its words quoted at level 1; where
these are matched by nothing, to that of deeper levels. Roots are found by
pointer jumping. Everything is DataFrame operations.

A passage meets messages by the hash of one of its runs of words, of 8, 4, 2 or 1
words, whichever it has: the run of smallest hash. Only conversations with quotes
are looked at, and only runs that some passage asks for; a message that has the
run is a candidate, and one that holds the whole passage is an original.

No window runs over a conversation or over the messages that hold a passage:
the latest earlier original is found within blocks of turns, then among the last
originals of earlier blocks. The result carries the order in columns: sorted by
conversation, root_turn, turn, every message follows the one it replies to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmill.scratch import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The marks before a quoted line, line breaks, and a line that announces a quotation.
MARKS, BREAKS, ANNOUNCED = r"^(?:[ \t]*>)+[ \t]?", r"\r\n|\n|\r", r"^[^>].*:[ \t]*$"
#: Words of the runs that passages and messages meet by.
RUNS = (8, 4, 2, 1)
#: Turns of a block.
BLOCK = 1024


def normalise(text: Column) -> Column:
    return F.translate(F.trim(F.regexp_replace(text, "[ \t\n\u00a0]+", " ")), UPPER, LOWER)


def parsed_lines(text: Column) -> Column:
    """Array of (level, body, solid) for each line; level 0 is the message's own text, solid lines have any."""

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        body = F.substring(line, F.length(marks) + 1, F.length(line))
        return F.struct(level.alias("level"), body.alias("body"), (normalise(body) != "").alias("solid"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), BREAKS), parse)


def passages(lines: Column) -> Column:
    """Array of (level, norm): the quoted passages in order, normalised."""
    numbers = F.sequence(F.lit(1), F.size(lines))
    quoted = lambda i: F.element_at(lines, i)["solid"] & (F.element_at(lines, i)["level"] > 0)

    def joined(i: Column, j: Column) -> Column:
        """Whether neighbouring lines i and j are of one passage."""
        return quoted(i) & quoted(j) & (F.element_at(lines, i)["level"] == F.element_at(lines, j)["level"])

    begins = F.filter(numbers, lambda i: quoted(i) & ((i == 1) | ~joined(i, F.greatest(i - 1, F.lit(1)))))
    ends = F.filter(numbers, lambda i: quoted(i) & ((i == F.size(lines)) | ~joined(i, F.least(i + 1, F.size(lines)))))

    def passage(a: Column, b: Column) -> Column:
        bodies = F.transform(F.sequence(a, b), lambda i: F.element_at(lines, i)["body"])
        return F.struct(F.element_at(lines, a)["level"].alias("level"), normalise(F.array_join(bodies, " ")).alias("norm"))

    return F.zip_with(begins, ends, passage)


def own_text(lines: Column) -> Column:
    """The lines of level 0, without one that ends in a colon right before a quotation."""
    numbers = F.sequence(F.lit(1), F.size(lines))

    def kept(i: Column) -> Column:
        line, after = F.element_at(lines, i), F.element_at(lines, F.least(i + 1, F.size(lines)))
        announces = (after["level"] > 0) & F.regexp_like(line["body"], F.lit(ANNOUNCED))
        return (line["level"] == 0) & ~announces

    return F.trim(F.array_join(F.transform(F.filter(numbers, kept), lambda i: F.element_at(lines, i)["body"]), "\n"), F.lit(" \t\n"))


def runs_of(words: Column, size: int) -> Column:
    """Hashes of the runs of ``size`` words; none in a shorter text."""
    places = F.sequence(F.lit(1), F.size(words) - size + 1)
    hashes = F.transform(places, lambda i: F.xxhash64(F.lit(size), *[F.element_at(words, i + j) for j in range(size)]))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def _originals(quoted: DataFrame, messages: DataFrame) -> DataFrame:
    """(conv, hash, origin): messages whose own text holds a quoted passage. ``messages`` is (conv, turn, own)."""
    # Words are a column of their own before they are walked over, or each step would split the text again.
    smallest = F.coalesce(*[F.when(F.size("words") >= n, F.array_min(runs_of(F.col("words"), n))) for n in RUNS])
    distinct = quoted.groupBy("conv", "hash").agg(F.min("norm").alias("norm")).withColumn("words", F.split("norm", " "))
    asked = cut(distinct.select("conv", "hash", "norm", smallest.alias("run")), "quoted-passages")
    held = cut(messages.join(asked.select("conv").distinct(), "conv", "left_semi"), "quote-messages")
    split = held.select("conv", F.col("turn").alias("origin"), F.split("own", " ").alias("words"))
    # The outer form: of the inner one Spark infers a filter on the array, with the split text inside its steps.
    runs = split.select("conv", "origin", F.explode_outer(F.array_distinct(F.concat(*[runs_of(F.col("words"), n) for n in RUNS]))).alias("run"))
    met = runs.join(asked.select("conv", "run", "hash"), ["conv", "run"]).select("conv", "origin", "hash").distinct()
    texts = met.join(asked.select("conv", "hash", "norm"), ["conv", "hash"]).join(held.withColumnRenamed("turn", "origin"), ["conv", "origin"])
    within = F.contains(F.concat(F.lit(" "), "own", F.lit(" ")), F.concat(F.lit(" "), "norm", F.lit(" ")))
    return texts.filter(within).select("conv", "hash", "origin").distinct()


def _latest_before(quoted: DataFrame, originals: DataFrame) -> DataFrame:
    """(conv, hash, turn, origin): for each quoting turn the latest earlier original, where there is one."""
    block = lambda c: F.floor(F.col(c) / BLOCK)
    points = quoted.select("conv", "hash", "turn", F.lit(None).cast("long").alias("origin")).distinct()
    points = points.unionByName(originals.select("conv", "hash", F.col("origin").alias("turn"), "origin")).withColumn("block", block("turn"))
    inside = Window.partitionBy("conv", "hash", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = points.withColumn("near", F.max("origin").over(inside)).filter("origin IS NULL")
    blocks = points.groupBy("conv", "hash", "block").agg(F.max("origin").alias("last"))
    earlier = Window.partitionBy("conv", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "hash", "block", F.max("last").over(earlier).alias("far"))
    found = near.join(blocks, ["conv", "hash", "block"]).select("conv", "hash", "turn", F.coalesce("near", "far").alias("origin"))
    return found.filter("origin IS NOT NULL")


def reply_order(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Return per row of ``df``: conversation, turn, role, parent_turn, root_turn, n_passages, n_linked, deepest, own_text.

    ``parent_turn`` is the earlier message this one replies to (null: none
    found), ``root_turn`` the first of its chain. ``n_passages`` counts the
    message's quoted passages, ``n_linked`` those with an earlier original,
    ``deepest`` is the highest quote level. Of originals with as many quoted
    words the later one is the parent. Null text counts as empty. Rows that
    share conversation and turn are one message in the links: their passages are
    pooled and each gets its row. A null conversation or turn links nothing; its
    root_turn is its turn. Turns are whole numbers. Other columns are not read.
    """
    rows = df.select(F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), parsed_lines(F.col(text)).alias("lines"))
    known = rows.filter("conv IS NOT NULL AND turn IS NOT NULL")
    quoted = known.select("conv", "turn", F.explode(passages(F.col("lines"))).alias("p")).select("conv", "turn", "p.*")
    quoted = quoted.groupBy("conv", "turn", "level", "norm").agg(F.count(F.lit(1)).alias("n")).withColumn("hash", F.unhex(F.md5(F.col("norm").cast("binary"))))
    quoted = cut(quoted, "quoted")
    messages = known.select("conv", "turn", normalise(own_text(F.col("lines"))).alias("own"))
    origins = _latest_before(quoted, cut(_originals(quoted, messages), "quote-originals"))
    linked = quoted.join(origins, ["conv", "hash", "turn"], "left").withColumn("words", F.size(F.split("norm", " ")) * F.col("n"))
    by_origin = linked.groupBy("conv", "turn", "level", "origin").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    choice = F.max(F.when(F.col("origin").isNotNull(), F.struct((-F.col("level")).alias("near"), F.col("words").alias("words"), F.col("origin").alias("origin"))))
    links = by_origin.groupBy("conv", "turn").agg(choice["origin"].alias("parent"), F.sum(F.when(F.col("origin").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"))
    links = cut(links, "quote-links")
    roots = _roots(links.filter("parent IS NOT NULL").select("conv", "turn", "parent"))

    told = rows.select(
        "conv",
        "turn",
        "role",
        F.size(passages(F.col("lines"))).alias("n_passages"),
        F.array_max(F.transform("lines", lambda x: x["level"])).alias("deepest"),
        own_text(F.col("lines")).alias("own_text"),
    )
    placed = told.join(links, ["conv", "turn"], "left").join(roots, ["conv", "turn"], "left")
    return placed.select(
        F.col("conv").alias(conversation),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"),
        "n_passages",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "deepest",
        "own_text",
    )


def _roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, root) of every message with a parent, by pointer jumping.

    The distance to the root halves with every step, which is written, so a
    chain of n replies takes log n steps.
    """
    pointers = cut(parents.select("conv", "turn", F.col("parent").alias("root")), "quote-roots")
    while True:
        above = pointers.select("conv", F.col("turn").alias("root"), F.col("root").alias("further"))
        step = cut(pointers.join(above, ["conv", "root"], "left").select("conv", "turn", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "quote-roots")
        pointers = step.select("conv", "turn", "root")
        if step.filter("moved").isEmpty():
            return pointers


SQL = rf"""
WITH RECURSIVE lines AS (
    SELECT conv_id, turn, role, row_id, unnest(string_split_regex(coalesce(text, ''), '{BREAKS}')) AS line,
           generate_subscripts(string_split_regex(coalesce(text, ''), '{BREAKS}'), 1) AS i
    FROM (SELECT *, row_number() OVER () AS row_id FROM conversations)
), marked AS (
    SELECT *, regexp_extract(line, '{MARKS}') AS marks FROM lines
), parsed AS (
    SELECT conv_id, turn, role, row_id, i, length(marks) - length(replace(marks, '>', '')) AS level, line[length(marks) + 1:] AS body
    FROM marked
), stepped AS (
    SELECT *, regexp_matches(body, '[^ \t\n\x{{A0}}]') AS solid, lead(level) OVER (PARTITION BY row_id ORDER BY i) AS after FROM parsed
), grouped AS (
    SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY i) AS passage
    FROM (SELECT *, NOT solid OR level IS DISTINCT FROM lag(level) OVER w OR NOT lag(solid) OVER w AS fresh
          FROM stepped WINDOW w AS (PARTITION BY row_id ORDER BY i))
), told AS (
    SELECT row_id, any_value(conv_id) AS conv_id, any_value(turn) AS turn, any_value(role) AS role, max(level) AS deepest,
           count(DISTINCT passage) FILTER (level > 0 AND solid) AS n_passages,
           trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0 AND NOT (coalesce(after, 0) > 0 AND regexp_matches(body, '{ANNOUNCED}'))), ''), concat(' ', chr(9), chr(10))) AS own_text
    FROM grouped GROUP BY row_id
), own AS (
    SELECT conv_id, turn, ' ' || translate(trim(regexp_replace(own_text, '[ \t\n\x{{A0}}]+', ' ', 'g')), '{UPPER}', '{LOWER}') || ' ' AS own FROM told
), quoted AS (
    SELECT conv_id, turn, any_value(level) AS level,
           translate(trim(regexp_replace(string_agg(body, ' ' ORDER BY i), '[ \t\n\x{{A0}}]+', ' ', 'g')), '{UPPER}', '{LOWER}') AS norm
    FROM grouped WHERE level > 0 AND solid AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn, row_id, passage
), linked AS (
    SELECT *, len(string_split(norm, ' ')) AS words,
           (SELECT max(o.turn) FROM own o WHERE o.conv_id = q.conv_id AND o.turn < q.turn AND contains(o.own, ' ' || q.norm || ' ')) AS origin
    FROM quoted q
), by_origin AS (
    SELECT conv_id, turn, level, origin, count(*) AS n, sum(words) AS words FROM linked GROUP BY ALL
), links AS (
    SELECT conv_id, turn, first(origin ORDER BY level, words DESC, origin DESC) FILTER (origin IS NOT NULL) AS parent,
           sum(n) FILTER (origin IS NOT NULL) AS n_linked
    FROM by_origin GROUP BY ALL
), chain AS (
    SELECT conv_id, turn, parent AS root FROM links WHERE parent IS NOT NULL
    UNION ALL
    SELECT c.conv_id, c.turn, l.parent FROM chain c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.root WHERE l.parent IS NOT NULL
), roots AS (
    SELECT conv_id, turn, min(root) AS root FROM chain GROUP BY ALL
)
SELECT t.conv_id, t.turn, t.role, l.parent AS parent_turn, coalesce(r.root, t.turn) AS root_turn, CAST(n_passages AS INTEGER) AS n_passages,
       CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, CAST(deepest AS INTEGER) AS deepest, own_text
FROM told t LEFT JOIN links l ON l.conv_id = t.conv_id AND l.turn = t.turn LEFT JOIN roots r ON r.conv_id = t.conv_id AND r.turn = t.turn
"""
