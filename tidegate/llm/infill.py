"""Fill-in-middle transformation by secondary sort.

A text is cut into units, runs of letters and single other characters; hashes of its key choose two cuts and the
order of the three parts. Chunks of units travel as pieces keyed by row and place in the output, and
`repartitionAndSortWithinPartitions` brings the pieces of a row together in order, so the output is read as a
stream: its digest grows piece by piece and no task holds an output. The same stream, cut at its marks, is keyed by
place in the original and sorted again, where it already is, to restore the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import ship

# The marks, the hundredths of texts that change, and of these the hundredths with the suffix first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
# The parts of an output in its order, as (mark, place in the original).
ORDER = {
    PLAIN: (("", 0),),
    PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
    SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
}
# Units in a piece, and characters that are looked at at a time.
UNITS, STRETCH = 8_192, 1 << 20
# Bytes of text that a partition is to hold.
PARTITION_BYTES = 128 << 20
# The first piece of a row states its form; restored rows begin with the digest of the output.
HEAD = -1


def unit_starts(text: str, after_letter: bool) -> np.ndarray:
    """Where units begin in a stretch of text that follows a letter or does not."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (points < 128) & ((points | 32) >= ord("a")) & ((points | 32) <= ord("z"))
    begins = ~letter
    begins[1:] |= ~letter[:-1]
    if len(begins) and not after_letter:
        begins[0] = True
    return np.flatnonzero(begins)


def is_letter(character: str) -> bool:
    return character.isascii() and character.isalpha()


def stretches(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, starts of units in it) of each stretch of a text."""
    for offset in range(0, len(text), STRETCH):
        yield offset, unit_starts(text[offset : offset + STRETCH], offset > 0 and is_letter(text[offset - 1]))


def count_units(text: str) -> int:
    return sum(len(starts) for _, starts in stretches(text))


def boundaries(text: str, wanted: list[int], n: int) -> tuple[list[int], list[int]]:
    """Where the units with the numbers ``wanted`` begin, the end of the text for ``n``; and every `UNITS`-th start."""
    found, each, seen = {n: len(text)}, [], 0
    for offset, starts in stretches(text):
        for k in wanted:
            if seen <= k < seen + len(starts):
                found[k] = offset + int(starts[k - seen])
        each += [offset + int(s) for s in starts[-seen % UNITS :: UNITS]]
        seen += len(starts)
    return [found[k] for k in wanted], each


def plan(text: str, digest: str) -> tuple[int, str, int, int, list[int]]:
    """(units, form, end of the prefix, end of the middle, places where pieces may be cut) of a text."""
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = count_units(text)
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    form = PLAIN if not text or marked or h3 % 100 >= CHANGED else SPM if h4 % 100 < SUFFIX_FIRST else PSM
    (first, second), cuts = boundaries(text, sorted((h1 % (n + 1), h2 % (n + 1))), n)
    return n, form, first, second, cuts


def pieces(row: int, key: object, text: str, digest: str) -> Iterator[tuple[tuple[int, int], object]]:
    """The pieces of a row, keyed by row and place in the output: what is known of it, then chunks of units."""
    n, form, first, second, cuts = plan(text, digest)
    chars = (None, None) if form == PLAIN else (first, second - first)
    yield (row, HEAD), (key, n, form, *chars)
    parts = ((0, len(text)),) if form == PLAIN else ((0, first), (first, second), (second, len(text)))
    place = 0
    for mark, part in ORDER[form]:
        start, end = parts[part]
        inner = cuts[int(np.searchsorted(cuts, start, "right")) : int(np.searchsorted(cuts, end))]
        for begin, stop in zip((start, *inner), (*inner, end), strict=True):
            yield (row, place), (mark + text[begin:stop]).encode("utf-8", "surrogatepass")
            mark, place = "", place + 1


@dataclass
class Splitter:
    """Cuts a streamed output at its marks, given its form and nothing else: (place in the original, chunk)."""

    form: str
    waiting: list[tuple[bytes, int]] = field(default_factory=list)
    part: int = 0
    held: bytes = b""

    def __post_init__(self) -> None:
        self.waiting = [(mark.encode(), part) for mark, part in ORDER[self.form] if mark]

    def feed(self, chunk: bytes) -> Iterator[tuple[int, bytes]]:
        data = self.held + chunk
        while self.waiting and (at := data.find(self.waiting[0][0])) >= 0:
            mark, part = self.waiting.pop(0)
            yield self.part, data[:at]
            self.part, data = part, data[at + len(mark) :]
        # The end may be the beginning of a mark.
        keep = min(len(data), len(PREFIX) - 1) if self.waiting else 0
        self.held = data[len(data) - keep :] if keep else b""
        yield self.part, data[: len(data) - keep]

    def close(self) -> Iterator[tuple[int, bytes]]:
        if self.waiting:
            raise ValueError("the output lacks a mark")
        yield self.part, self.held


def by_row(key: tuple[int, ...]) -> int:
    """Partitioner: all pieces of a row together, rows spread by an odd factor."""
    return (key[0] * 0x9E3779B97F4A7C15 >> 16) & 0x7FFFFFFF


def _assembled(stream: Iterator[tuple[tuple[int, int], object]]) -> Iterator[tuple[tuple[int, int, int], object]]:
    """Digests of sorted outputs, and their chunks keyed by place in the original."""

    def finish() -> Iterator[tuple[tuple[int, int, int], object]]:
        for part, data in splitter.close():
            if data:
                yield (row, part, place + 1), data
        yield (row, HEAD, 0), (*known, digest.hexdigest())

    row = None
    for (this, _), value in stream:
        if this != row:
            if row is not None:
                yield from finish()
            row, known, digest, splitter, place = this, value, hashlib.sha256(), Splitter(value[2]), 0
            continue
        digest.update(value)
        for part, data in splitter.feed(value):
            place += 1
            if data:
                yield (row, part, place), data
    if row is not None:
        yield from finish()


def _restored(stream: Iterator[tuple[tuple[int, int, int], object]]) -> Iterator[tuple[object, ...]]:
    """What is known of a row, the digest of its output and that of the restored text, from sorted chunks."""
    row = None
    for (this, _, _), value in stream:
        if this != row:
            if row is not None:
                yield (*known, digest.hexdigest())
            row, known, digest = this, value, hashlib.sha256()
        else:
            digest.update(value)
    if row is not None:
        yield (*known, digest.hexdigest())


def key_digest(key: Column) -> Column:
    """The hash that decides cuts, form and order; of no key at all where it is NULL."""
    return F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)


def numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, text, digest) with a number for each row, so that equal rows and keys stay apart."""
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "k", "t", key_digest(F.col("k")).alias("d"))


def sorted_pieces(df: DataFrame, key: str = "doc_id", text: str = "text") -> RDD:
    """((row, place in the output), chunk) of all rows, those of a row in one partition and in order.

    The number of partitions follows the bytes of the texts, which are summed first, and is that of the session's shuffle
    partitions at least.
    """
    spark = df.sparkSession
    ship(spark)
    rows = numbered(df, key, text).rdd
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = max(-(-size // PARTITION_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.flatMap(lambda r: pieces(r["row"], r["k"], r["t"], r["d"]))
    return found.repartitionAndSortWithinPartitions(partitions, by_row)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n (units), form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of each row.

    A NULL or empty text is plain with no units. Rows with a NULL key are cut by the hash of an empty key; repeated
    keys and rows are transformed each by itself; an empty table gives an empty one; other columns are ignored. Long
    texts become many pieces: after they are cut, no task holds a text or an output whole.

    The second sort takes place in the partitions of the first, which have all pieces of a row already, and moves
    nothing between tasks.
    """
    sorted_out = sorted_pieces(df, key, text)
    keyed = sorted_out.mapPartitions(_assembled, preservesPartitioning=True)
    again = keyed.repartitionAndSortWithinPartitions(sorted_out.getNumPartitions(), by_row)
    schema = f"`{key}` {_kind(df, key)}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return df.sparkSession.createDataFrame(again.mapPartitions(_restored), T.StructType.fromDDL(schema), verifySchema=False)


def _kind(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _outputs(stream: Iterator[tuple[tuple[int, int], object]]) -> Iterator[tuple[object, str, str]]:
    row, known, chunks = None, (), []
    for (this, _), value in stream:
        if this != row:
            if row is not None:
                yield known[0], known[2], b"".join(chunks).decode("utf-8", "surrogatepass")
            row, known, chunks = this, value, []
        else:
            chunks.append(value)
    if row is not None:
        yield known[0], known[2], b"".join(chunks).decode("utf-8", "surrogatepass")


def transform(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, form and the whole ``output`` of each row, for writing; other rules as in `digests`. A task holds one
    output at a time."""
    schema = T.StructType.fromDDL(f"`{key}` {_kind(df, key)}, form string, output string")
    return df.sparkSession.createDataFrame(sorted_pieces(df, key, text).mapPartitions(_outputs), schema, verifySchema=False)


def digests_sql() -> str:
    """DuckDB SQL for `digests` over ``documents``."""
    part = "array_to_string(list_slice(u, {0}, {1}), '')"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
k AS (
  SELECT doc_id, t, u, len(u) AS n, {', '.join(f"('0x' || substr(h, {8 * i + 1}, 8))::UBIGINT AS h{i + 1}" for i in range(4))} FROM d),
c AS (
  SELECT doc_id, t, u, n, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
    CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {CHANGED} THEN '{PLAIN}'
      WHEN h4 % 100 < {SUFFIX_FIRST} THEN '{SPM}' ELSE '{PSM}' END AS form FROM k),
p AS (
  SELECT doc_id, t, n, form, {part.format(1, 'a')} AS p, {part.format('a + 1', 'b')} AS m, {part.format('b + 1', 'n')} AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> '{PLAIN}' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    WHEN '{SPM}' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE t END) AS output_sha256,
  sha256(p || m || s) AS restored_sha256 FROM p"""
