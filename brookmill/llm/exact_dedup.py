"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters over (first 32 characters,
digest, id) of the normalised text and sorted outside memory, which places equal
texts next to each other. Each task then compares neighbouring texts in full.
The splitters hold at most 32 characters and a digest, so the sample the driver
draws stays small however long the texts are; the id in the key lets a text
that a third of all rows share spread over many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.llm.rows import one_row_where
from brookmill.scratch import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalise(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


#: Tasks that the rows of one repeated text are dealt to when they get their group's result; texts met once are not moved.
SALTS = 8


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each sorted row with the one before it, over batch borders too.

    ``variant`` counts the different texts met so far under one digest, so that
    even a digest collision keeps texts apart; ``repeat`` marks a row whose text
    and id equal those of the row before; ``alone`` one whose text differs from
    both neighbours. The first and last row of the partition are not alone: the
    same text may go on in the next one.
    """
    last: pa.Table | None = None
    held: tuple[int, bool, bool] | None = None  # variant and repeat of the last row, and whether it equals the one before
    first = True

    def rows(some: pa.Table, variants: list[int], repeats: list[bool], alone: list[bool]) -> pa.RecordBatch:
        columns = [some["id"].combine_chunks(), some["digest"].combine_chunks()]
        return pa.RecordBatch.from_arrays([*columns, pa.array(variants, pa.int32()), pa.array(repeats, pa.bool_()), pa.array(alone, pa.bool_())], ["id", "digest", "variant", "repeat", "alone"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.table(batch).rename_columns(["id", "norm", "digest"])
        table = pa.concat_tables([last, table]) if last is not None else table
        before, after = table.slice(0, table.num_rows - 1), table.slice(1)
        same_text = [d and t for d, t in zip(*(pc.equal(after[c], before[c]).to_pylist() for c in ("digest", "norm")), strict=True)]
        same_digest = pc.equal(after["digest"], before["digest"]).to_pylist()
        both_null = pc.and_(pc.is_null(after["id"]), pc.is_null(before["id"])).to_pylist()
        same_id = pc.equal(after["id"], before["id"]).fill_null(False).to_pylist()
        variant, repeat, joined = held or (0, False, True)
        variants, repeats, linked = [variant], [repeat], [joined]
        for text, digest, key, null in zip(same_text, same_digest, same_id, both_null, strict=True):
            variant = variant + (not text) if digest else 0
            variants.append(variant)
            repeats.append(text and (key or null))
            linked.append(text)
        alone = [not (x or y) for x, y in zip(linked[:-1], linked[1:], strict=True)]
        if first:
            alone[:1] = [False] * len(alone[:1])
        if alone:
            first = False
            yield rows(before, variants[:-1], repeats[:-1], alone)
        last, held = table.slice(table.num_rows - 1), (variants[-1], repeats[-1], linked[-1])
    if last is not None:
        yield rows(last, [held[0]], [held[1]], [False])


def content_sort(df: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """Return per row of ``df``: key, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised text the one with the smallest (or, with
    ``keep="largest"``, the largest) key stays. Null text counts as empty. A
    null key is smaller than any other for "largest" and larger for "smallest";
    a group of null keys only keeps one row with a null ``keep_id``. Rows that
    repeat both text and key count in ``group_size``, and one of them is kept.
    Other columns are not read. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    norm = df.select(F.col(key).cast("long").alias("id"), normalise(F.col(text)).alias("norm"))
    keyed = norm.withColumn("digest", F.sha2(F.col("norm").cast("binary"), 256)).withColumn("head", F.substring("norm", 1, 32))
    ordered = keyed.repartitionByRange("head", "digest", "id").sortWithinPartitions("head", "digest", "norm", "id")
    compared = ordered.select("id", "norm", F.unhex("digest").alias("digest")).mapInArrow(
        _compare_neighbours, "id long, digest binary, variant int, repeat boolean, alone boolean"
    )
    rows = cut(compared, "content-sort")
    best = F.max("id") if keep == "largest" else F.min("id")
    groups = rows.filter("NOT alone").groupBy("digest", "variant").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own_salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    joined = rows.filter("NOT alone").withColumn("salt", own_salt).join(groups, ["digest", "variant", "salt"])
    columns = ["id", "digest", "repeat", "keep_id", "group_size"]
    single = rows.filter("alone").select("id", "digest", "repeat", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return single.unionByName(joined.select(*columns)).select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & ~F.col("repeat")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first_copies(df: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """The kept rows of :func:`content_sort` with all columns of ``df``.

    Rows that repeat both key and normalised text become one: the one whose text
    is first in code point order, of equal texts that of the smallest row hash.
    Extra columns may have any names.
    """
    kept = content_sort(df, text, key, keep).filter("kept")
    digest = F.sha2(normalise(F.col(text)).cast("binary"), 256)
    return one_row_where(df, kept, key, digest, F.col("text_sha256"), F.col(text))


SQL = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents
), n AS (
    SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) AS place
    FROM t
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM n
"""
