"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so half the
hash evaluations are needed for a signature. The values are banded; documents that share a band are
candidates, and every link is confirmed on the full shingle sets of the two texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.common import SLICE_ROWS, map_rows, ship
from tidegate.llm.components import components
from tidegate.operators.membership import spread_join
from tidegate.workspace import Staged, release, stage

# 32 bands of 4 values from 64 permutations: of pairs at similarity 0.8, one in 20 million shares no band.
BANDS, ROWS = 32, 4
PERMUTATIONS = BANDS * ROWS // 2
SEED = 20_240_601
# Word hashes remembered by a task; shingles that are permuted at a time.
CACHE_WORDS, STRETCH = 100_000, 16_384


def words_of(text: str | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased; other characters stay as they are."""
    return text.encode().lower().split() if text else []


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``width`` words; a shorter text is one run."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width)), strict=False))


class Signer:
    """Shingle hashes and banded min-max signatures of texts."""

    def __init__(self, width: int) -> None:
        self.width = width
        draw = np.random.default_rng(SEED)
        self.factors = draw.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = draw.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
        self.mixers = draw.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.numbers = draw.integers(1, 2**63, BANDS, dtype=np.uint64)
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Distinct 64-bit hashes of the shingles, sorted."""
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        single = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            mixed = (mixed ^ single[k : len(words) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(PERMUTATIONS, np.uint64)
        for start in range(0, len(hashes), STRETCH):
            permuted = hashes[None, start : start + STRETCH] * self.factors[:, None] + self.offsets[:, None]
            permuted ^= permuted >> np.uint64(32)
            permuted *= np.uint64(0xD6E8FEB86659FD93)
            np.minimum(low, permuted.min(axis=1), out=low)
            np.maximum(high, permuted.max(axis=1), out=high)
        # Each band takes minima of some permutations and maxima of others.
        half = ROWS // 2
        values = np.concatenate([low.reshape(BANDS, half), np.roll(high, half).reshape(BANDS, half)], axis=1)
        mixed = self.numbers.copy()
        for k in range(ROWS):
            mixed = (mixed ^ values[:, k]) * self.mixers[k]
            mixed ^= mixed >> np.uint64(31)
        return mixed.view(np.int64)


def signatures(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key``, ``n`` (shingles), ``digest`` of the shingle set (NULL for an empty set) and its ``bands``."""

    def make():
        signer = Signer(width)

        def one(value, key_value):
            hashes = signer.hashes(words_of(value))
            if not len(hashes):
                return key_value, 0, None, None
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            return key_value, len(hashes), digest, signer.bands(hashes)

        return one

    kind = df.schema[key].dataType.simpleString()
    return map_rows(df, [text, key], f"`{key}` {kind}, n long, digest binary, bands array<long>", make)


def close_sizes(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be as similar as asked."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) have shingle sets of ``percent`` similarity or more."""
    left = spread_join(pairs, texts.select(F.col("id").alias("a"), F.col("text").alias("__left")), ["a"], "inner")
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("__right"))
    both = spread_join(left, right, ["b"], "inner").select("a", "b", "__left", "__right")
    schema = pairs.select("a", "b").schema
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last_set = None, set()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                similar = []
                for mine, other in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if other != last_text:
                        last_text, last_set = other, shingles(words_of(other), width)
                    own = shingles(words_of(mine), width)
                    common = len(own & last_set)
                    similar.append(bool(common) and 100 * common >= percent * (len(own) + len(last_set) - common))
                kept = part.select([0, 1]).filter(pa.array(similar, pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, schema=out)

    ship(pairs.sparkSession)
    return both.mapInArrow(run, schema)


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 2, percent: int = 80
) -> DataFrame:
    """``key``, n_shingles, component_id and kept of each row.

    Texts are linked where 100 * intersection >= ``percent`` * union of their shingle sets; component_id is
    the least key reachable over links, kept says that it is the row's own.

    A NULL or empty text has no shingles and no links. Rows with a NULL key take no part in links: they are
    their own component (NULL) and kept. Rows with one key are one document. Repeated rows give repeated
    results, an empty table an empty one; long texts are hashed whole; other columns are ignored.

    Copies fold into one representative before anything is compared. In each bucket of a band, members are
    first compared with one of them, later with another. Of those that are in different components even then,
    pairs are compared that can be similar by their rarest shingles (`_by_rare_shingles`), which misses none. So
    a large group costs a few comparisons per member.
    """
    spark = df.sparkSession
    rows = stage(signatures(df, key, text, width), "signatures")
    present = rows.df.where(F.col("digest").isNotNull() & F.col(key).isNotNull())
    # One row per shingle set; equal sets have equal bands.
    classes = present.groupBy("digest").agg(
        F.min(key).alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = stage(classes, "classes")
    members = classes.df.select("node", "n", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("band")
    members = stage(spread_join(members, shared, ["band"], "inner"), "members")
    nodes = members.df.select(F.col("node").alias(key)).distinct()
    texts = df.select(key, text).join(nodes, key, "left_semi").select(F.col(key).alias("id"), F.col(text).alias("text"))
    texts = stage(texts, "texts")

    known, tried, used = None, None, []
    for rule in ("least", "other", "rare"):
        pairs = _candidates(members.df, texts.df, known, rule, width, percent)
        if tried is not None:
            both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(both, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs", F.count(F.lit(1)).alias("n"))
        used.append(pairs.path)
        if not pairs.metrics["n"]:
            continue
        tried = pairs.df if tried is None else tried.unionByName(pairs.df)
        found = stage(confirm(pairs.df, texts.df, width, percent), "confirmed")
        known = _joined_up(known, found.df)
        used += [found.path, known.path]
        known = known.df

    labelled = classes.df.select("digest", "node")
    if known is not None:
        labelled = labelled.join(known, "node", "left")
        labelled = labelled.select("digest", F.coalesce("component", "node").alias("component_id"))
    else:
        labelled = labelled.withColumnRenamed("node", "component_id")
    joined = spread_join(rows.df.select(key, "n", "digest"), labelled, ["digest"], "left")
    component = F.when(F.col(key).isNotNull(), F.coalesce("component_id", key))
    result = joined.select(
        key,
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col(key) == component, F.lit(True)).alias("kept"),
    )
    result = stage(result, "near-duplicates")
    release(spark, rows.path, classes.path, members.path, texts.path, *used)
    return result.df


def _joined_up(known: DataFrame | None, links: DataFrame) -> Staged:
    """(node, component) after further ``links``, from the components so far: the links are contracted to them, so only
    what they join is gone through again."""
    if known is None:
        return stage(components(links), "components")

    def contracted(df: DataFrame, end: str) -> DataFrame:
        met = spread_join(df, known.withColumnRenamed("node", end), [end], "left")
        return met.withColumn(end, F.coalesce("component", end)).drop("component")

    joined = stage(components(contracted(contracted(links, "a"), "b")), "components")
    moved = joined.df.select(F.col("node").alias("component"), F.col("component").alias("__to"))
    before = spread_join(known, moved, ["component"], "left").select("node", F.coalesce("__to", "component").alias("component"))
    new = joined.df.join(known.select("node"), "node", "left_anti")
    after = stage(before.unionByName(new.select("node", "component")), "components")
    release(links.sparkSession, joined.path)
    return after


def _candidates(
    members: DataFrame, texts: DataFrame, known: DataFrame | None, rule: str, width: int, percent: int
) -> DataFrame:
    """Pairs (a, b) of documents that share a band and are in different components so far.

    ``least`` and ``other`` pair each member of a bucket with one of it: the least node, or the one whose hash
    with the band is least, so that a group meets other partners in each band. ``rare`` finds all other pairs.
    """
    if known is None:
        placed = members.withColumn("c", F.col("node"))
    else:
        placed = spread_join(members, known, ["node"], "left").withColumn("c", F.coalesce("component", "node"))
        mixed = placed.groupBy("band").agg(F.min("c").alias("__l"), F.max("c").alias("__h")).where("__l <> __h")
        placed = spread_join(placed, mixed.select("band"), ["band"], "inner").select("node", "n", "band", "c")
        placed = stage(placed, "apart").df
    if rule == "rare":
        return _by_rare_shingles(placed.select("node", "c").distinct(), texts, width, percent)
    order = F.col("node") if rule == "least" else F.xxhash64("node", "band")
    hub = F.min(F.struct(order.alias("o"), F.col("node").alias("b"), F.col("n").alias("__n"), F.col("c").alias("__c")))
    hubs = placed.groupBy("band").agg(hub.alias("__hub")).select("band", "__hub.b", "__hub.__n", "__hub.__c")
    joined = spread_join(placed.withColumnRenamed("node", "a"), hubs, ["band"], "inner").where("c <> __c")
    return joined.where(close_sizes(F.col("n"), F.col("__n"), percent)).select("a", "b").distinct()


def _by_rare_shingles(nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of ``nodes`` (node, c) of different c that may be similar, none of those that are left out.

    Sets of n and m shingles that are similar enough share k = ceil(percent (n + m) / (100 + percent)) of them. So, in
    any order of all shingles, the first one that they share is among the first n - k + 1 of the one and the first
    m - k + 1 of the other. Rare shingles come first in the order, so few sets meet; and for each shingle only sets
    outside its most frequent c are paired with all that hold it.
    """

    def make():
        signer = Signer(width)
        return lambda value, node, c: (node, c, signer.hashes(words_of(value)).view(np.int64))

    held = texts.withColumnRenamed("id", "node").join(nodes, "node")
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = f"node {kinds['node']}, c {kinds['c']}, shingles array<long>"
    sets = map_rows(held, ["text", "node", "c"], schema, make)
    sets = stage(sets.withColumn("row", F.monotonically_increasing_id()), "sets").df
    each = sets.select("row", F.explode("shingles").alias("s"))
    frequent = each.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    each = spread_join(each, frequent, ["s"], "left").select("row", F.struct(F.coalesce("f", F.lit(1)).alias("f"), "s").alias("s"))
    ordered = each.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("s"))
    sized = sets.select("row", "node", "c", F.size("shingles").cast("long").alias("n")).join(ordered, "row")
    # With the smallest set that can be similar, ceil(percent n / 100) shingles are shared.
    length = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    first = sized.select("node", "c", "n", F.posexplode(F.slice("s", F.lit(1), length)).alias("at", "s"))
    first = stage(first.where("s.f > 1").select("node", "c", "n", "at", "s.s"), "rare").df
    by_c = first.groupBy("s", "c").agg(F.count(F.lit(1)).alias("k"))
    most = by_c.groupBy("s").agg(F.max(F.struct("k", "c")).alias("m"), F.count(F.lit(1)).alias("cs")).where("cs > 1")
    first = spread_join(first, most.select("s", F.col("m.c").alias("most")), ["s"], "inner")
    left = first.where("c <> most").select("s", F.col("node").alias("x"), F.col("c").alias("cx"), F.col("n").alias("nx"), F.col("at").alias("ax"))
    right = first.select("s", F.col("node").alias("y"), F.col("c").alias("cy"), F.col("n").alias("ny"), F.col("at").alias("ay"))
    shared = F.ceil((F.col("nx") + F.col("ny")) * percent / (100 + percent))
    reach = (F.col("ax") <= F.col("nx") - shared) & (F.col("ay") <= F.col("ny") - shared)
    joined = left.join(right, "s").where((F.col("cx") != F.col("cy")) & reach)
    return joined.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def near_duplicates_sql() -> str:
    """DuckDB SQL for `near_duplicates` over ``documents``: all pairs that share a shingle, and their closure."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT r.node, p.b FROM r JOIN p ON r.c = p.a),
m AS (SELECT node, min(c) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, len(s.s) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN m ON s.doc_id = m.node"""
