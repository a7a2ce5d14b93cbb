"""Benchmark decontamination by a distributed positional inverted index.

The words of all documents are stored as postings: for each term of a segment, a stretch of documents that one task
has read, the positions where it stands. Phrases are looked up by their terms, the rarest first: its positions, less
its offset in the phrase, are the places where the phrase can begin, and each further list, adjusted by its own
offset, leaves fewer of them. With a tolerance the same search finds phrases whose words stand near their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.common import SLICE_ROWS, ship
from tidegate.operators.membership import spread_join
from tidegate.workspace import Staged, release, stage

# Words in a window, and how far a word may stand from its place in a proximity match.
WIDTH, SLOP = 10, 2
# Positions after which a segment is closed.
SEGMENT = 1 << 21
# Free positions between documents; more than twice any tolerance, so no match reaches over them.
GAP, LARGEST_SLOP = 256, 64
# Bytes of a text that are cut into words at a time, and places that are looked at at a time.
STRETCH, PLACES = 1 << 20, 1 << 21
# Term numbers stand above positions in one number.
TERM_SHIFT, BEFORE = 40, 1 << 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Lower-cases A-Z and turns all that is in no word into spaces. Bytes above 127 are parts of words.
FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a stretch at a time."""
    data = data.translate(FOLDED)
    start = 0
    while start < len(data):
        end = start + STRETCH
        if end < len(data):
            # A word that is longer than a stretch ends at the next space.
            cut = data.rfind(b" ", start, end)
            cut = data.find(b" ", end) if cut < 0 else cut
            end = len(data) if cut < 0 else cut
        yield data[start:end].split()
        start = end + 1


def varints(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers in base 128, least digits first, and where the bytes of each begin, with the end of all."""
    values = values.astype(np.uint64)
    width = np.ones(len(values), np.int64)
    for k in range(1, 9):
        width += values >= np.uint64(1 << (7 * k))
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(width)])
    out = np.zeros(int(begin[-1]), np.uint8)
    for k in range(int(width.max(initial=0))):
        some = np.flatnonzero(width > k)
        digit = (values[some] >> np.uint64(7 * k)).astype(np.uint8) & 127
        out[begin[some] + k] = digit | ((width[some] > k + 1).astype(np.uint8) << 7)
    return out.tobytes(), begin


def of_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, and the byte after each."""
    ends = np.flatnonzero(data < 128) + 1
    if not len(ends):
        return np.zeros(0, np.int64), ends
    begins = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
    shift = (np.arange(len(data)) - np.repeat(begins, ends - begins)) * 7
    return np.add.reduceat((data & 127).astype(np.int64) << shift, begins), ends


class Numbers(dict[bytes, int]):
    """Terms by the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Segment:
    """The postings of a stretch of documents."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.terms = Numbers()
        self.found: list[np.ndarray] = []
        self.docs: list[tuple[object, int]] = []
        self.words = 0

    def add(self, key: object, data: bytes | None) -> None:
        before = self.words
        for words in words_of(data or b""):
            self.found.append(np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words)))
            self.words += len(words)
        self.docs.append((key, self.words - before))

    def is_full(self) -> bool:
        return self.words + GAP * len(self.docs) >= SEGMENT

    def rows(self, out: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row for each term, after one without a term that has the documents and where each begins."""
        lengths = np.array([n for _, n in self.docs], np.int64)
        bases = np.cumsum(lengths + GAP) - (lengths + GAP)
        steps = np.diff(bases, prepend=0)
        starts, _ = varints(steps)
        keys = pa.array([k for k, _ in self.docs], out[4].type.value_type[0].type)
        docs = pa.StructArray.from_arrays([keys, pa.array(lengths)], fields=list(out[4].type.value_type))
        held = pa.ListArray.from_arrays(pa.array([0, len(self.docs)], pa.int32()), docs).cast(out[4].type)
        head = [pa.array([self.number]), pa.array([None], pa.string()), pa.array([self.words]), pa.array([starts]), held]
        yield pa.RecordBatch.from_arrays(head, schema=out)
        if not self.words:
            return
        ids = np.concatenate(self.found)
        order = np.argsort(ids, kind="stable")
        positions = (np.arange(self.words) + np.repeat(np.arange(len(lengths)) * GAP, lengths))[order]
        counts = np.bincount(ids, minlength=len(self.terms))
        first = np.cumsum(counts) - counts
        steps = np.diff(positions, prepend=0)
        steps[first] = positions[first]
        data, begin = varints(steps)
        ends = np.append(begin[first], len(data)).astype(np.int32)
        names = list(self.terms)
        name_ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, names), np.int64, len(names)))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(names), self.number)),
                pa.StringArray.from_buffers(len(names), pa.py_buffer(name_ends), pa.py_buffer(b"".join(names))),
                pa.array(counts),
                pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(ends), pa.py_buffer(data)]),
                pa.nulls(len(names), out[4].type),
            ],
            schema=out,
        )


@dataclass(frozen=True)
class Index:
    """A stored index: (segment, term, n, postings) of every term of a segment, and the documents of each segment."""

    table: DataFrame
    path: str

    @property
    def postings(self) -> DataFrame:
        return self.table.where("term IS NOT NULL").select("segment", "term", "n", "postings")

    @property
    def documents(self) -> DataFrame:
        """segment, row (its place in the segment), key and n_words of each row that was indexed."""
        heads = self.table.where("term IS NULL").select("segment", F.posexplode("docs").alias("row", "d"))
        return heads.select("segment", "row", "d.key", "d.n_words")


def _schema(kind: str) -> str:
    return f"segment long, term string, n long, postings binary, docs array<struct<key: {kind}, n_words: bigint>>"


def build(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> Index:
    """Index the words of every whole text; the index is written to ``path``, or to the shared folder.

    A segment holds some two million positions, or one longer text; its number follows from the task that reads it. A NULL or
    empty text has no words, but its row is kept; rows with NULL or repeated keys are indexed each by itself.
    """
    ship(df.sparkSession)
    schema = _schema(df.schema[key].dataType.simpleString())
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        segment = Segment(number)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                texts, keys = (c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns)
                for data, own in zip(texts, keys, strict=True):
                    segment.add(own, data)
                    if segment.is_full():
                        yield from segment.rows(out)
                        number += 1
                        segment = Segment(number)
        if segment.docs:
            yield from segment.rows(out)

    written = stage(df.select(F.col(text).cast("binary"), key).mapInArrow(run, schema), "postings", path=path)
    return Index(written.df, written.path)


def stored(spark: SparkSession, path: str) -> Index:
    """An index that was written before."""
    return Index(spark.read.parquet(path), path)


def words_column(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def windows_of(items: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(``terms``, ``item``) of every run of ``width`` words of a text; all its words if they are fewer."""
    cut = items.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("item"), words_column(F.col(text)).alias("w"))
    size = F.size("w")
    starts = F.when(size > 0, F.sequence(F.lit(1), F.greatest(size - (width - 1), F.lit(1))))
    cut = cut.select("item", "w", F.explode(starts).alias("at"))
    return cut.select(F.slice("w", F.col("at"), F.lit(width)).alias("terms"), "item").distinct()


def _ranges(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


class Lists:
    """The decoded postings of a segment that some phrases ask for."""

    def __init__(self, terms: list[str | None], postings: list[bytes]) -> None:
        head = terms.index(None)
        self.bases = np.cumsum(of_varints(np.frombuffer(postings[head], np.uint8))[0])
        kept = [k for k in range(len(terms)) if k != head]
        self.number = {terms[k]: i for i, k in enumerate(kept)}
        steps, ends = of_varints(np.frombuffer(b"".join(postings[k] for k in kept), np.uint8))
        closed = np.cumsum([len(postings[k]) for k in kept])
        last = np.searchsorted(ends, closed, "right")
        self.begin = np.concatenate([np.zeros(1, np.int64), last])[:-1].astype(np.int64)
        self.count = np.diff(np.concatenate([np.zeros(1, np.int64), last]))
        summed = np.cumsum(steps)
        before = np.concatenate([np.zeros(1, np.int64), summed])[self.begin]
        self.positions = summed - np.repeat(before, self.count)
        self.keys = self.positions + (np.repeat(np.arange(len(kept), dtype=np.int64), self.count) << TERM_SHIFT)

    def matches(
        self, lengths: np.ndarray, numbers: np.ndarray, offsets: np.ndarray, slop: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(phrase, start, document) of the places where every word of a phrase is within ``slop`` of its own place.

        The words of each phrase are given one after the other, the rarest first; ``lengths`` has their numbers.
        """
        begin = np.cumsum(lengths) - lengths
        rarest = self.count[numbers[begin]]
        block = np.cumsum(rarest * (2 * slop + 1)) // PLACES
        for some in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(block)) + 1):
            if not len(some):
                continue
            anchors = numbers[begin[some]]
            which = np.repeat(some, self.count[anchors])
            start = self.positions[_ranges(self.begin[anchors], self.count[anchors])] - offsets[begin[which]]
            if slop:
                which = np.repeat(which, 2 * slop + 1)
                start = np.repeat(start, 2 * slop + 1) + np.tile(np.arange(-slop, slop + 1), len(start))
                # A start may be before the first position.
                both = np.unique((which << TERM_SHIFT) + start + BEFORE)
                which, start = both >> TERM_SHIFT, (both & ((1 << TERM_SHIFT) - 1)) - BEFORE
            for rank in range(1, int(lengths[some].max())):
                more = lengths[which] > rank
                at = begin[which[more]] + rank
                low = (numbers[at].astype(np.int64) << TERM_SHIFT) + start[more] + offsets[at] - slop
                next_key = np.searchsorted(self.keys, low)
                found = np.append(self.keys, np.iinfo(np.int64).max)[next_key] <= low + 2 * slop
                kept = np.ones(len(which), bool)
                kept[more] = found
                which, start = which[kept], start[kept]
                if not len(which):
                    break
            if len(which):
                document = np.searchsorted(self.bases, start + offsets[begin[which]] + slop, "right") - 1
                yield which, start, document


def _look_up(held: pa.Table, asked: pa.Table, slop: int, out: pa.Schema) -> pa.Table:
    """The matches of the phrases that are alive in a segment: (segment, row, w, exact) of each phrase and document that
    holds it or comes near it, and (segment, row, n_hit) of each document with words inside exact matches."""
    empty = out.empty_table()
    if not asked.num_rows or not held.num_rows:
        return empty
    lists = Lists(held["term"].to_pylist(), held["postings"].to_pylist())
    terms = asked["terms"].combine_chunks()
    lengths = np.diff(terms.offsets.to_numpy())
    flat = terms.flatten()
    offsets = flat.field("at").to_numpy().astype(np.int64)
    numbers = np.fromiter((lists.number.get(t, -1) for t in flat.field("term").to_pylist()), np.int64, len(flat))
    phrase = np.repeat(np.arange(len(lengths)), lengths)
    whole = np.ones(len(lengths), bool)
    whole[phrase[numbers < 0]] = False
    # Words that are rarest in this segment come first.
    some = np.flatnonzero(whole[phrase])
    some = some[np.lexsort((lists.count[numbers[some]], phrase[some]))]
    phrases, lengths = asked["w"].to_numpy()[whole], lengths[whole]
    if not len(phrases):
        return empty
    pairs: list[tuple[np.ndarray, np.ndarray, bool]] = []
    of_pairs = len(phrases)
    width = int(lists.positions.max(initial=0)) + GAP + int(lengths.max())
    marks = np.zeros(width + 1, np.int32)
    for tolerance in sorted({0, slop}):
        for found, start, document in lists.matches(lengths, numbers[some], offsets[some], tolerance):
            both = np.unique(document * of_pairs + found)
            pairs.append((both // of_pairs, phrases[both % of_pairs], tolerance == 0))
            if not tolerance:
                np.add.at(marks, start, 1)
                np.add.at(marks, start + lengths[found], -1)
    hits = np.add.reduceat(np.append(np.cumsum(marks) > 0, [False]).astype(np.int32), np.minimum(lists.bases, width))
    hit = np.flatnonzero(hits)
    row = np.concatenate([hit, *(p[0] for p in pairs)])
    is_pair = np.arange(len(row)) >= len(hit)
    columns = [
        pa.array(np.full(len(row), held["segment"][0].as_py())),
        pa.array(row.astype(np.int32)),
        pa.array(np.concatenate([np.zeros(len(hit), np.int64), *(p[1] for p in pairs)]), mask=~is_pair),
        pa.array(np.concatenate([np.zeros(len(hit), bool), *(np.full(len(p[0]), p[2]) for p in pairs)]), mask=~is_pair),
        pa.array(np.concatenate([hits[hit].astype(np.int64), np.zeros(len(row) - len(hit), np.int64)]), mask=is_pair),
    ]
    return pa.Table.from_arrays(columns, schema=out)


def search(index: Index, phrases: DataFrame, slop: int = SLOP) -> DataFrame:
    """Exact and proximity matches of ``phrases`` (w long, terms array<string>) in an index.

    Rows are (segment, row, w, exact, n_hit): one for each phrase and document in which every word of the phrase
    stands within ``slop`` words of its place behind some start (``exact`` false), another where all stand in their
    places (``exact`` true), and one without ``w`` for each document with words inside exact matches. A phrase of which some word is in no
    document is dropped at once, and a segment looks only for phrases of whose words it has the rarest. What a task holds is
    the postings of one segment and the phrases that may be in it.
    """
    return _matches(index, phrases, slop).df


def _matches(index: Index, phrases: DataFrame, slop: int) -> Staged:
    if not 0 <= slop <= LARGEST_SLOP:
        raise ValueError(f"the tolerance must be 0 to {LARGEST_SLOP}, not {slop}")
    terms = stage(phrases.select(F.explode("terms").alias("term")).distinct(), "terms")
    places = stage(spread_join(index.postings.drop("postings"), terms.df, ["term"], "inner"), "places")
    totals = places.df.groupBy("term").agg(F.sum("n").alias("total"))
    words = phrases.select("w", F.size("terms").alias("size"), F.posexplode("terms").alias("at", "term"))
    ranked = words.join(totals, "term").groupBy("w", "size").agg(F.array_sort(F.collect_list(F.struct("total", "term", "at"))).alias("terms"))
    ranked = ranked.where(F.size("terms") == F.col("size")).withColumn("term", F.col("terms")[0]["term"])
    ranked = stage(ranked.select("w", "term", "terms"), "ranked")
    alive = spread_join(places.df.select("segment", "term"), ranked.df, ["term"], "inner")
    alive = alive.select("segment", "w", F.transform("terms", lambda t: F.struct(t["term"].alias("term"), t["at"].alias("at"))).alias("terms"))
    lists = spread_join(index.postings, terms.df, ["term"], "inner").select("segment", "term", "postings")
    lists = lists.unionByName(index.table.where("term IS NULL").select("segment", "term", "postings"))

    schema = "segment long, row int, w long, exact boolean, n_hit long"
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        return _look_up(held, asked, slop, out)

    ship(phrases.sparkSession)
    found = stage(lists.groupBy("segment").cogroup(alive.groupBy("segment")).applyInArrow(run, schema), "matches")
    release(phrases.sparkSession, terms.path, places.path, ranked.path)
    return found


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    slop: int = SLOP,
) -> DataFrame:
    """``key``, n_words, n_hit, n_items, items_sha256, contaminated, n_near and near_sha256 of each row of ``docs``.

    A window is ``width`` consecutive words of an item, or all words of a shorter one. Words inside exact occurrences
    are hit; n_items and items_sha256 tell which items have some, n_near and near_sha256 which have windows whose
    every word stands within ``slop`` words of its place. A NULL or empty text has no words, in documents and items. Items
    with a NULL id take no part, those with one id are one item, items without words are in no document. Rows with
    NULL or repeated keys and repeated rows are judged each by itself, in full length; empty tables give no rows, or rows
    without hits; other columns are ignored.
    """
    spark = docs.sparkSession
    windows = stage(windows_of(items, item, item_text, width), "windows")
    phrases = windows.df.select("terms").distinct().withColumn("w", F.monotonically_increasing_id())
    phrases = stage(phrases, "phrases")
    members = stage(windows.df.join(phrases.df, "terms").select("w", "item"), "members")
    index = build(docs, key, text)
    matches = _matches(index, phrases.df, slop)
    found = matches.df

    pairs = found.where("w IS NOT NULL").groupBy("segment", "row", "w").agg(F.max("exact").alias("exact"))
    held = spread_join(pairs, members.df, ["w"], "inner").groupBy("segment", "row", "item").agg(F.max("exact").alias("exact"))
    listed = held.groupBy("segment", "row").agg(
        F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"),
        F.array_sort(F.collect_list("item")).alias("near"),
    )
    hits = found.where("w IS NULL").select("segment", "row", "n_hit")
    result = index.documents.join(listed, ["segment", "row"], "left").join(hits, ["segment", "row"], "left")
    none = F.array().cast("array<string>")
    exact, near = F.coalesce("items", none), F.coalesce("near", none)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    # What only this operator reads is let go of once the result is written.
    result = stage(
        result.select(
            F.col("key").alias(key),
            "n_words",
            n_hit.alias("n_hit"),
            F.size(exact).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", exact).cast("binary"), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
            F.size(near).cast("long").alias("n_near"),
            F.sha2(F.concat_ws(",", near).cast("binary"), 256).alias("near_sha256"),
        ),
        "contamination",
    )
    release(spark, windows.path, phrases.path, members.path, index.path, matches.path)
    return result.df


def decontaminate_sql(width: int = WIDTH, slop: int = SLOP) -> str:
    """DuckDB SQL for `decontaminate` over ``documents`` and ``benchmark``: phrases by their text, proximity by the places
    of the rarest word."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item, w[s:s + {width - 1}] AS p FROM (
  SELECT item, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
p AS MATERIALIZED (SELECT row_number() OVER () AS k, p, len(p) AS n FROM (SELECT DISTINCT p FROM iw)),
l AS (SELECT DISTINCT n FROM p),
dw AS MATERIALIZED (SELECT r, unnest(w) AS t, generate_subscripts(w, 1) AS at FROM d),
o AS MATERIALIZED (
  SELECT c.r, c.s, p.k, p.n FROM (
    SELECT r, s, w[s:s + n - 1] AS p FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, l)) c JOIN p USING (p)),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM o) GROUP BY r),
pt AS MATERIALIZED (SELECT k, n, unnest(p) AS t, generate_subscripts(p, 1) - 1 AS o FROM p),
f AS (SELECT t, count(*) AS c FROM dw WHERE t IN (SELECT t FROM pt) GROUP BY t),
a AS (SELECT k, n, arg_min(struct_pack(t := t, o := o), (c, t, o)) AS a FROM pt JOIN f USING (t) GROUP BY k, n HAVING count(*) = n),
s AS (SELECT DISTINCT dw.r, a.k, a.n, dw.at - a.a.o + unnest(range(-{slop}, {slop + 1})) AS s FROM a JOIN dw ON dw.t = a.a.t),
g AS (
  SELECT DISTINCT r, k FROM (
    SELECT s.r, s.k, s.s, s.n FROM s JOIN pt ON pt.k = s.k
    JOIN dw ON dw.r = s.r AND dw.t = pt.t AND dw.at BETWEEN s.s + pt.o - {slop} AND s.s + pt.o + {slop}
    GROUP BY s.r, s.k, s.s, s.n HAVING count(DISTINCT pt.o) = s.n)),
e AS (SELECT r, list_sort(list(DISTINCT item)) AS x FROM (SELECT DISTINCT r, k FROM o) JOIN p USING (k) JOIN iw USING (p) GROUP BY r),
m AS (SELECT r, list_sort(list(DISTINCT item)) AS x FROM g JOIN p USING (k) JOIN iw USING (p) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(len(e.x), 0) AS n_items,
  sha256(coalesce(array_to_string(e.x, ','), '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated,
  coalesce(len(m.x), 0) AS n_near, sha256(coalesce(array_to_string(m.x, ','), '')) AS near_sha256
FROM d LEFT JOIN h USING (r) LEFT JOIN e USING (r) LEFT JOIN m USING (r)"""
