"""Spelling variants: words one edit apart, found by pivotal grams.

All bigrams have one global order, rare ones first. A word's prefix is its three
first bigrams in that order (one edit changes two at most). Among the prefix,
dynamic programming picks two disjoint bigrams, the pivots, that stand in the
fewest words. One edit hits one pivot at most, so of two words one edit apart
the one whose prefix ends earlier has a pivot that stands unchanged in the
prefix of the other. Pivots are joined to prefixes under limits of position: an
unchanged bigram keeps its distance from one end of the word, and everything on
that side is unchanged too. What meets is verified by edit distance in the join,
so only links leave it.

All of it is DataFrame operations over the distinct words; texts are read once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.scratch import cut

RUN = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def planted(run: Column, key: Column, one_in: int) -> Column:
    """``run`` without one of its characters where ``one_in`` divides the CRC-32 of ``key:run``; 0 plants none."""
    if not one_in:
        return run
    h = F.crc32(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(df: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = 6, least_count: int = 5, one_in: int = 199) -> DataFrame:
    """Return (word, n): runs of letters with A-Z lower-cased, with a character deleted by hash here and there, and their number.

    Words under ``least_length`` characters or ``least_count`` occurrences drop
    out. Null text has no words; a null key hashes as the empty text.
    """
    runs = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{least_length},}}"), F.lit(0)))
    found = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), runs.alias("run"))
    words = found.select("key", F.translate("run", _UPPER, _LOWER).alias("run")).select(planted(F.col("run"), F.col("key"), one_in).alias("word"))
    words = words.filter(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


_GRAM = "struct<words:bigint,gram:string,at:int>"


def _pivots(prefix: Column) -> Column:
    """The two disjoint bigrams of a prefix that stand in the fewest words, by dynamic programming over positions.

    State: the cheapest bigram that the last one does not overlap (``far``), the
    last one (``near``), and the cheapest pair so far.
    """
    none = F.lit(None)
    start = F.struct(none.cast(_GRAM).alias("far"), none.cast(_GRAM).alias("near"), none.cast(f"struct<words:bigint,one:{_GRAM},two:{_GRAM}>").alias("best"))

    def step(state: Column, gram: Column) -> Column:
        further = F.least(state["far"], state["near"])
        free = F.when(state["near"]["at"] + 1 >= gram["at"], state["far"]).otherwise(further)
        pair = F.when(free.isNotNull(), F.struct((free["words"] + gram["words"]).alias("words"), free.alias("one"), gram.alias("two")))
        return F.struct(further.alias("far"), gram.alias("near"), F.least(state["best"], pair).alias("best"))

    by_place = F.array_sort(prefix, lambda a, b: a["at"] - b["at"])
    return F.aggregate(by_place, start, step, lambda state: F.array(state["best"]["one"], state["best"]["two"]))


def pivotal_grams(words: DataFrame) -> DataFrame:
    """Return (word, n, size, last, prefix, pivots) for rows (word, n) of words with four characters or more.

    ``prefix`` holds the three first bigrams of the global order (words that
    hold it, bigram, place) and, of the next two, those that equal the third,
    ``last``. One edit makes two bigrams at most, so a pivot of a near word,
    which is among the first three there, is among the first five here.
    """
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select("word", "n", F.explode(places).alias("at")).withColumn("gram", F.substring("word", F.col("at"), F.lit(2)))
    known = cut(grams.groupBy("gram").agg(F.count_distinct("word").alias("words")), "bigram-words")
    listed = grams.join(known, "gram").groupBy("word", "n").agg(F.sort_array(F.collect_list(F.struct("words", "gram", "at"))).alias("grams"))
    order = lambda g: F.struct(g["words"], g["gram"])
    found = listed.withColumn("last", order(F.element_at("grams", 3))).withColumn("prefix", F.filter(F.slice("grams", 1, 5), lambda g: order(g) <= F.col("last")))
    return found.select("word", "n", F.char_length("word").alias("size"), "last", "prefix", _pivots(F.slice("grams", 1, 3)).alias("pivots"))


def links(words: DataFrame) -> DataFrame:
    """Return (word, n, other, other_n) for every two words one edit apart, in both directions, from rows (word, n)."""
    table = cut(pivotal_grams(words), "pivotal-grams")

    def parts(grams: str) -> DataFrame:
        """The word up to each bigram and from it on: what one edit on its other side leaves unchanged."""
        rows = table.select("word", "n", "size", "last", F.explode(grams).alias("gram"))
        at = F.col("gram")["at"]
        upto, onward = F.substring("word", F.lit(1), at + 1), F.substring("word", at, F.col("size"))
        return rows.select("word", "n", "size", "last", F.inline(F.array(F.struct(F.lit("upto").alias("side"), upto.alias("part")), F.struct(F.lit("from").alias("side"), onward.alias("part")))))

    index = parts("prefix").select("side", "size", "part", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("last").alias("other_last"))
    probes = parts("pivots").withColumn("size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    one_edit = F.levenshtein("word", "other", 1) == 1
    met = probes.join(index, ["side", "size", "part"]).filter((F.col("last") <= F.col("other_last")) & one_edit)
    pairs = met.select(F.least("word", "other").alias("a"), F.greatest("word", "other").alias("b"), F.when(F.col("word") < F.col("other"), F.col("n")).otherwise(F.col("other_n")).alias("x"), F.when(F.col("word") < F.col("other"), F.col("other_n")).otherwise(F.col("n")).alias("y"))
    ways = F.array(*[F.struct(F.col(a).alias("word"), F.col(x).alias("n"), F.col(b).alias("other"), F.col(y).alias("other_n")) for a, x, b, y in (("a", "x", "b", "y"), ("b", "y", "a", "x"))])
    return pairs.distinct().select(F.inline(ways))


def spelling_variants(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    least_length: int = 6,
    least_count: int = 5,
    times: int = 5,
    one_in: int = 199,
) -> DataFrame:
    """Return per word: word, n, n_near, form, form_n, root.

    Words are those of :func:`word_counts`. Two are near if they differ by
    exactly one inserted, deleted or replaced character; ``n_near`` counts the
    near ones. ``form`` is the near word of largest n, of equals the smallest in
    code point order, if its n (``form_n``) is ``times`` that of the word or
    more, else null. ``root`` is where following forms ends, the word itself if
    it has none. Null and empty texts add no words, an empty table gives no
    rows, repeated rows count each. Only ``text`` and ``key`` are read.
    """
    if least_length < 4 or least_count < 1 or times < 2:
        raise ValueError("words have four characters, counts are 1 and times 2 at least")
    words = cut(word_counts(df, text, key, least_length, least_count, one_in), "spelling-words")
    near = links(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    better = -F.col("best")["less"] >= F.col("n") * times
    near = cut(near.select("word", "n_near", F.when(better, F.col("best")["other"]).alias("form"), F.when(better, -F.col("best")["less"]).alias("form_n")), "spelling-near")

    # Each form has ``times`` the count of the word before, which bounds the way to a root; every round doubles what is covered.
    most = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(max(most / least_count, 1), times)))
    roots = near.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = cut(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    done = words.join(near, "word", "left").join(roots, "word", "left")
    return done.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
