"""Mixing sources to target weights along a time-varying curriculum, with DataFrame operations only.

Each source follows a weight schedule over training time 0 to 1. The integral of
a schedule is the source's share of the mix; shares that would take a source
more often than allowed are cut and the excess is shared again by weight. The
integral up to a time, as a part of the whole, is the cumulative demand for the
source's words. Documents of a source are laid end to end in the order of a
keyed hash, once for every pass over the source; inverting the demand at the word
where a document begins gives its training position. Sorting by that position in
ranges gives the training order.

A source may hold any part of the rows: its order is by buckets of the hash, whose
number follows from the row count, so a running sum over a source is one over its
buckets and one inside each bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmill.operators.prefix import running_sum
from brookmill.scratch import cut

#: Documents of a bucket of the hash order, about.
BUCKET_ROWS = 10_000
_SPACES = " \t\n\v\f\r"
_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Schedule:
    """A weight over training time as straight lines between knots (time, weight), from time 0 to time 1."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self) -> None:
        times = [t for t, _ in self.knots]
        if times[:1] != [0.0] or times[-1:] != [1.0] or times != sorted(set(times)) or min(w for _, w in self.knots) < 0 or self.integral <= 0:
            raise ValueError("a schedule goes from time 0 to time 1 in growing times, with weights of 0 or more and not all 0")

    def pieces(self) -> list[tuple[float, float, float, float, float, float]]:
        """(begin, end, weight at both, integral up to begin and to end) of each line."""
        out, upto = [], 0.0
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            area = (w0 + w1) * (t1 - t0) / 2
            out.append((t0, t1, w0, w1, upto, upto + area))
            upto += area
        return out

    @property
    def integral(self) -> float:
        return self.pieces()[-1][5]

    def time_at(self, part: Column) -> Column:
        """The time by which ``part`` (0 to 1) of the integral is reached: the inverse of cumulative demand."""
        area = part * F.lit(self.integral)
        out = F.lit(1.0)
        for t0, t1, w0, w1, below, upto in reversed([p for p in self.pieces() if p[5] > p[4]]):
            inside = area - F.lit(below)
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + inside * F.lit(2 * (w1 - w0) / (t1 - t0)), F.lit(0.0)))
            line = F.lit(t0) + F.coalesce(inside * F.lit(2.0) / F.nullif(root + F.lit(w0), F.lit(0.0)), F.lit(0.0))
            out = F.when(area < F.lit(upto), line).otherwise(out)
        return out


#: Weights 5, 2 and 1 of the mix: the first kind of source fades, the second is steady, the third grows.
SCHEDULES = (Schedule(((0.0, 8.0), (1.0, 2.0))), Schedule(((0.0, 2.0), (1.0, 2.0))), Schedule(((0.0, 0.5), (1.0, 1.5))))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and \\t-\\r; null counts none. One character per word is held."""
    ones = F.regexp_replace(F.coalesce(text, F.lit("")), _WORD, "x")
    return F.length(F.translate(ones, _SPACES, "")).cast("long")


def source_targets(sizes: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, share: float = 1.5, most_passes: int = 2) -> DataFrame:
    """Return (source, source_size, kind, target) from rows (source, source_size), one for each source.

    Sources in code point order take the schedules in turn, and share ``share``
    of all words by their integrals. A target stops at ``most_passes`` times the
    size; the excess is shared again by weight until none is above. That ends
    with one common level: every target is the lesser of its bound and
    level x weight. Sources in the order of bound / weight reach their bounds
    one after the other, so the level follows from running sums.
    """
    ordered = running_sum(sizes.withColumn("one", F.lit(1)).withColumn("all", F.lit(1)), ["all"], "source", "one", "place", tie=["source_size"])
    weight = F.element_at(F.array(*[F.lit(s.integral) for s in schedules]), F.col("kind") + 1)
    bound = F.col("source_size").cast("double") * F.lit(float(most_passes))
    weighed = ordered.withColumn("kind", F.pmod(F.col("place") - 1, F.lit(len(schedules))).cast("int")).withColumn("weight", weight).withColumn("bound", bound)
    weighed = cut(weighed.withColumn("ratio", F.col("bound") / F.col("weight")).drop("one", "place"), "weighed-sources")
    whole = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, weights = (whole["words"] or 0) * float(share), whole["weights"] or 0.0
    filled = running_sum(weighed, ["all"], "ratio", "bound", "bounds", tie=["source"])
    filled = running_sum(filled, ["all"], "ratio", "weight", "weights", tie=["source"])
    level = (F.lit(words) - (F.col("bounds") - F.col("bound"))) / (F.lit(weights) - F.col("weights") + F.col("weight"))
    # Levels fall from the first source on that they do not take to its bound.
    reached = filled.agg(F.max(F.when(level <= F.col("ratio"), level)).alias("level")).first()["level"]
    target = F.col("bound") if reached is None else F.least(F.col("bound"), F.lit(reached) * F.col("weight"))
    return weighed.select("source", "source_size", "kind", target.alias("target"))


def curriculum(
    df: DataFrame,
    schedules: tuple[Schedule, ...] = SCHEDULES,
    share: float = 1.5,
    most_passes: int = 2,
    seed: int = 42,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Return per row of ``df``, sorted by first training position: key, size, source_size, target, taken, passes.

    ``size`` counts the words of a text, ``target`` is its source's number of
    words in the mix (:func:`source_targets`, null source last), ``taken`` how
    many of them come from this row, repeats counted. The words taken from a
    source are its target rounded to a whole word: the document at the border of
    the last pass gives its first words only. ``passes`` lists what is taken as
    (position, words), one for each time; positions are training times from 0 to
    1, at which the first word is due. It is empty for rows that the mix leaves
    out, which come last. Equal inputs and parameters give equal rows on every
    run.

    Null text has no words; null sources are one source; a null key is drawn for
    as the empty text; rows that repeat key, source and size share the places
    that their number takes, in any order. Other columns are not read.
    """
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("size").cast("string")))
    # One text per source that is never null and sorts null last.
    named = F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))
    rows = df.select(F.col(key).alias("key"), named.alias("source"), word_count(F.col(text)).alias("size"))
    rows = cut(rows.withColumn("draw", drawn), "curriculum-sizes")
    digits = max(1, len(f"{rows.count() // bucket_rows:x}"))
    rows = rows.withColumn("bucket", F.substring("draw", 1, digits))
    buckets = cut(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "curriculum-buckets")
    targets = cut(source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), schedules, share, most_passes), "curriculum-targets")
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    places = buckets.withColumn("ahead", F.coalesce(before, F.lit(0))).drop("words").join(targets, "source")

    inside = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("draw", "key", "size").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(places, ["source", "bucket"])
    quota = F.floor(F.col("target") + F.lit(0.5))
    passes = []
    for i in range(most_passes):
        begin = F.col("ahead") + F.col("inside") + F.col("source_size") * F.lit(i)
        words = F.least(F.greatest(quota - begin, F.lit(0)), F.col("size"))
        part = begin.cast("double") / F.nullif(quota, F.lit(0)).cast("double")
        time = F.element_at(F.array(*[s.time_at(part) for s in schedules]), F.col("kind") + 1)
        passes.append(F.when(words > 0, F.struct(time.alias("position"), words.alias("words"))))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda total, one: total + one["words"])
    done = placed.withColumn("passes", F.array_compact(F.array(*passes))).withColumn("taken", taken)
    done = done.orderBy(F.get("passes", F.lit(0))["position"].asc_nulls_last(), "draw", "key")
    return done.select(F.col("key").alias(key), "size", "source_size", "target", "taken", "passes")


#: The result of op13 in SQL.
SQL = r"""
WITH sizes AS (
  SELECT doc_id, coalesce('0' || source, '1') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), drawn AS (
  SELECT *, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size) AS draw FROM sizes
), weighed AS (
  SELECT source, source_size, kind, [5.0, 2.0, 1.0][kind + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS bound, 2.0::DOUBLE * source_size / [5.0, 2.0, 1.0][kind + 1]::DOUBLE AS ratio
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source) - 1) % 3 AS kind FROM drawn GROUP BY source)
), levels AS (
  SELECT ratio, (1.5::DOUBLE * (SELECT sum(source_size) FROM weighed) - coalesce(sum(bound) OVER ahead, 0))
                / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER ahead, 0)) AS level
  FROM weighed WINDOW ahead AS (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT *, least(bound, (SELECT max(level) FROM levels WHERE level <= ratio) * weight) AS target FROM weighed
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.kind, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM drawn d JOIN targets t ON d.source = t.source
), timed AS (
  SELECT *, greatest(least(quota - place, size), 0) AS first_words, greatest(least(quota - place - source_size, size), 0) AS more_words,
         CASE WHEN quota > 0 THEN CAST(place AS DOUBLE) / CAST(quota AS DOUBLE) END AS part
  FROM placed
)
SELECT doc_id, size, source_size, target, CAST(first_words + more_words AS BIGINT) AS taken,
       CASE WHEN first_words > 0 THEN CASE kind
         WHEN 0 THEN part * 5 * 2 / (sqrt(64 + part * 5 * -12) + 8)
         WHEN 1 THEN part * 2 * 2 / (sqrt(4 + part * 2 * 0) + 2)
         ELSE part * 1 * 2 / (sqrt(0.25::DOUBLE + part * 1 * 2) + 0.5::DOUBLE) END END AS position
FROM timed
"""
