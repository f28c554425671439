"""Fill-in-the-middle transformation by repeated-capture matching.

A text is cut into units, each a word with the white space before it (white
space at the end is a unit of its own). One ``fullmatch`` of ``(unit)*`` with the
``regex`` library retains every repetition of its group, so ``ends(1)`` gives the
number of units and the offset of any border at once, without a walk over the
text. Two borders are drawn by a keyed hash of the key; what lies between them
becomes the middle and moves to the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.llm.windows import slices

#: Characters matched at once; every capture takes memory, so a longer text is matched in blocks that end with a unit.
BLOCK = 1 << 18
_UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"


@dataclass(frozen=True)
class Infilling:
    """Parameters: ``seed`` of the draws, ``rate`` of texts in 100 to transform, ``spm`` of these in 100 with the suffix first.

    The markers stand before prefix, suffix and middle. A text that holds one of
    them stays plain, so the parts of every other one can be told apart.
    """

    seed: int = 42
    rate: int = 50
    spm: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        markers = [self.prefix, self.suffix, self.middle]
        for m in markers:
            if not m or any(m in other for other in markers if other is not m) or any(m.startswith(o[i:]) for o in markers for i in range(1, len(o))):
                raise ValueError("markers must not be empty, hold each other or overlap")


@lru_cache(maxsize=1)
def _patterns():
    import regex

    return regex.compile(f"({_UNIT})*+"), regex.compile(r"(?<=[^\x20\x09-\x0D])[\x20\x09-\x0D]")


def unit_ends(text: str, block: int = BLOCK) -> list[int]:
    """Code point offsets behind each unit of ``text``."""
    units, border = _patterns()
    if len(text) <= block:
        return units.fullmatch(text).ends(1)
    ends: list[int] = []
    at = 0
    while at < len(text):
        found = border.search(text, min(at + block, len(text)))
        stop = found.start() if found else len(text)
        ends += units.fullmatch(text, at, stop).ends(1)
        at = stop
    return ends


def draws(seed: int, key: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of ``seed:key``; a null key counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(text: str, key: int | None, how: Infilling) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix characters, middle characters, output) of one text."""
    h1, h2, h3, h4 = draws(how.seed, key)
    ends = unit_ends(text)
    n = len(ends)
    if not text or h3 % 100 >= how.rate or any(m in text for m in (how.prefix, how.suffix, how.middle)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[i - 1] if i else 0 for i in (first, second))
    before, inner, after = text[:a], text[a:b], text[b:]
    if h4 % 100 < how.spm:
        return n, "spm", a, b - a, how.suffix + after + how.prefix + before + how.middle + inner
    return n, "psm", a, b - a, how.prefix + before + how.suffix + after + how.middle + inner


def rebuild(output: bytes, form: str, how: Infilling) -> bytes:
    """The text that :func:`transform` was given, from its output and form alone."""
    if form == "plain":
        return output
    first, second = (how.suffix, how.prefix) if form == "spm" else (how.prefix, how.suffix)
    second, last = second.encode(), how.middle.encode()
    one, rest = output[len(first.encode()) :].split(second, 1)
    two, inner = rest.split(last, 1)
    return two + inner + one if form == "spm" else one + inner + two


def fill_in_middle(df: DataFrame, how: Infilling = Infilling(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """Return per row of ``df``: key, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output (string).

    ``psm`` is prefix marker, prefix, suffix marker, suffix, middle marker,
    middle; ``spm`` has suffix marker and suffix first. Character counts are code
    points and null where the form is plain. Null text counts as empty; empty
    texts are plain with no units; a null key is drawn for as the empty text;
    rows that repeat key and text get equal rows; bytes that are no UTF-8 count
    as one character each and are kept. Other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1):
                texts = [t.decode("utf-8", "surrogateescape") for t in some.column(1).to_pylist()]
                done = [transform(t, k, how) for t, k in zip(texts, some.column(0).to_pylist(), strict=True)]
                n, form, before, inner, out = zip(*done, strict=True)
                outputs = pa.array([o.encode("utf-8", "surrogateescape") for o in out], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(before, pa.int64()), pa.array(inner, pa.int64()), outputs], ["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    done = rows.mapInArrow(cut, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return done.withColumn("output", F.col("output").cast("string")).withColumnRenamed("key", key)


def restored(df: DataFrame, how: Infilling = Infilling()) -> DataFrame:
    """Add ``restored``, the text rebuilt from ``output`` and ``form``, to rows of :func:`fill_in_middle`; ``output`` goes."""

    rest = [c for c in df.columns if c != "output"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, batch.num_columns - 1):
                forms = some.column(some.schema.get_field_index("form")).to_pylist()
                texts = [rebuild(o, f, how) for o, f in zip(some.columns[-1].to_pylist(), forms, strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(texts, pa.binary())], [*rest, "restored"])

    rows = df.select(*rest, F.col("output").cast("binary").alias("output"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "output")
    return rows.mapInArrow(build, f"{schema}, restored binary").withColumn("restored", F.col("restored").cast("string"))


#: The result of op12 in SQL.
SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT doc_id, body, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(units) + 1) AS one,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(units) + 1) AS two,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS kind,
         CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS side
  FROM cut
), parts AS (
  SELECT doc_id, body, n,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR kind >= 50 THEN 'plain'
              WHEN side < 80 THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(units[1:least(one, two)], ''), '') AS p,
         coalesce(array_to_string(units[least(one, two) + 1:greatest(one, two)], ''), '') AS m,
         coalesce(array_to_string(units[greatest(one, two) + 1:], ''), '') AS s
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
