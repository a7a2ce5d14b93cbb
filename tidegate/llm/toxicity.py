"""Toxicity by the nearest labelled examples.

Texts are TF-IDF vectors over the beginnings of their words, in the exact vocabulary of the examples. The nearest
examples of each label by exact cosine vote, the nearer the more, and the share of the toxic votes, calibrated on the
examples themselves, is the score. Examples stand in a block-max inverted index: the postings of a term are cut by
blocks of examples and each piece knows its largest weight, so a block whose bound is below the k-th cosine is skipped.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.common import SLICE_ROWS, map_rows, ship
from tidegate.workspace import release, stage

# Terms are the beginnings of words, of so many letters. Chosen with POWER by the labelled rows outside fold 0 alone.
BEGINNINGS = (4, 5)
# Labelled rows of each class that the examples are drawn from, and the bytes that an example may have at most.
EXAMPLES, EXAMPLE_BYTES = 2_000, 20_000
# Neighbours of each label that vote, and the power of the cosine that is a neighbour's vote.
NEIGHBOURS, POWER = 15, 8
# Terms that have a weight for every example, and queries that are summed over them at a time.
COMMON, QUERIES = 1_024, 64
# Examples in a block of the index, and the share of the blocks of a label that is looked at before the first test.
BLOCK, FIRST_SHARE = 128, 0.5
# Examples that the others are ordered around, so that those of a block are alike.
PIVOTS = 16
# Counts travel in parts of so many terms.
PART = 1 << 12
FOLDS = 5

# Keeps a-z and all that is not ASCII, turns the rest into spaces.
LETTERS = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
# Spaces and punctuation beyond ASCII.
OTHER_MARKS = re.compile("[\u00a0-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u00d7\u00f7\u2000-\u206f\u3000-\u303f\uff00-\uff20]+")


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    lowered = text.lower() if text else ""
    if not lowered.isascii():
        lowered = OTHER_MARKS.sub(" ", lowered)
    return lowered.encode("utf-8", "surrogatepass").translate(LETTERS).decode("utf-8", "surrogatepass").split()


def terms_of(word: str) -> list[str]:
    return [word[:n] for n in BEGINNINGS if len(word) >= n]


def term_counts(text: str | None) -> Counter[str]:
    found: Counter[str] = Counter()
    for word, n in Counter(words_of(text)).items():
        for term in terms_of(word):
            found[term] += n
    return found


class Vocabulary(dict[str, int]):
    """Terms and their numbers."""

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The known terms of a text, ascending, and how often each stands in it."""
        words, number = words_of(text), self.get
        flat = [number(word[:n], -1) for n in BEGINNINGS for word in words if len(word) >= n]
        terms, counts = np.unique(np.array(flat, np.int64), return_counts=True)
        return (terms[1:], counts[1:]) if len(terms) and terms[0] < 0 else (terms, counts)


def _ranges(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


Vector = tuple[np.ndarray, np.ndarray]


class Index:
    """A block-max inverted index of unit vectors with labels 0 and 1.

    Examples have slots, those of a label in blocks of their own. Terms that many examples hold have a weight for every
    slot, so that many queries are summed over them at once. The postings of all other terms are cut by blocks: the entries
    of a term are the blocks that hold it, each with its largest weight and where its postings are.
    """

    def __init__(self, vectors: list[Vector], labels: list[int], n_terms: int) -> None:
        self.slots = np.zeros(len(vectors), np.int64)
        first = 0
        self.blocks: list[tuple[int, int]] = []
        for label in (0, 1):
            own = [i for i, y in enumerate(labels) if y == label]
            for at, i in enumerate(_alike(vectors, own, n_terms)):
                self.slots[i] = first * BLOCK + at
            last = first - (-len(own) // BLOCK)
            self.blocks.append((first, last))
            first = last
        self.size = first * BLOCK
        lengths = np.array([len(t) for t, _ in vectors], np.int64)
        terms = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        weights = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        slots = np.repeat(self.slots, lengths)

        held = np.bincount(terms, minlength=n_terms)
        common = np.argsort(-held, kind="stable")[:COMMON]
        common = common[held[common] > 0]
        self.common = np.full(n_terms, -1)
        self.common[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.size), np.float32)
        row = self.common[terms]
        self.dense[row[row >= 0], slots[row >= 0]] = weights[row >= 0]

        terms, slots, weights = terms[row < 0], slots[row < 0], weights[row < 0]
        order = np.lexsort((slots, terms))
        terms, self.posting_slots, self.posting_weights = terms[order], slots[order], weights[order]
        blocks = self.posting_slots // BLOCK
        new = np.flatnonzero(np.diff(terms, prepend=-1) | np.diff(blocks, prepend=-1))
        self.entry_begin = new
        self.entry_length = np.diff(np.append(new, len(terms)))
        self.entry_block = blocks[new]
        self.entry_most = np.maximum.reduceat(self.posting_weights, new) if len(new) else np.zeros(0)
        self.term_entries = np.searchsorted(terms[new], np.arange(n_terms + 1))

    def nearest(self, queries: list[Vector], k: int, without: list[int] | None = None) -> list[list[list[tuple[float, int]]]]:
        """For each query and each label (cosine, slot) of its ``k`` nearest with a cosine above 0, nearest first;
        ``without`` a slot for each query."""
        asked = np.zeros((len(queries), len(self.dense)), np.float32)
        rare = []
        for row, (terms, weights) in enumerate(queries):
            at = self.common[terms]
            asked[row, at[at >= 0]] = weights[at >= 0]
            rare.append((terms[at < 0], weights[at < 0]))
        sums = (asked @ self.dense).astype(np.float64)
        if without is not None:
            sums[np.arange(len(queries)), without] = -np.inf
        return [self._nearest(scores, *query, k) for scores, query in zip(sums, rare, strict=True)]

    def _nearest(self, scores: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
        """The nearest, given the sums over common terms, which the other terms can only raise.

        A block whose largest sum, with all that its entries can add, is not above the k-th sum so far is skipped.
        """
        begin = self.term_entries[terms]
        lengths = self.term_entries[terms + 1] - begin
        entries = _ranges(begin, lengths)
        asked = np.repeat(weights, lengths)
        block = self.entry_block[entries]
        n_blocks = self.size // BLOCK
        most = scores.reshape(n_blocks, BLOCK).max(axis=1)
        adds = np.bincount(block, asked * self.entry_most[entries], minlength=n_blocks)
        bounds = (most + adds) * (1 + 1e-9)
        waiting = adds > 0
        look = np.zeros(n_blocks, bool)
        for first, last in self.blocks:
            some = max(-(-k // BLOCK) + 1, int((last - first) * FIRST_SHARE))
            look[first + np.argsort(-bounds[first:last], kind="stable")[:some]] = True
        look &= waiting
        while look.any():
            chosen = look[block]
            spans = self.entry_length[entries[chosen]]
            at = _ranges(self.entry_begin[entries[chosen]], spans)
            scores += np.bincount(self.posting_slots[at], self.posting_weights[at] * np.repeat(asked[chosen], spans), self.size)
            waiting &= ~look
            look = np.zeros(n_blocks, bool)
            for first, last in self.blocks:
                own = scores[first * BLOCK : last * BLOCK]
                kth = np.partition(own, -k)[-k] if len(own) > k else 0.0
                look[first:last] = waiting[first:last] & (bounds[first:last] > kth)
        found = []
        for first, last in self.blocks:
            own = scores[first * BLOCK : last * BLOCK]
            best = np.flatnonzero(own >= np.partition(own, -k)[-k]) if len(own) > k else np.arange(len(own))
            best = best[own[best] > 0]
            best = best[np.argsort(-own[best], kind="stable")][:k]
            found.append([(float(own[i]), int(i) + first * BLOCK) for i in best])
        return found


def _alike(vectors: list[Vector], own: list[int], n_terms: int) -> list[int]:
    """Some vectors in an order in which like ones are together: each with the nearest of a few pivots."""
    pivots = own[:: max(1, -(-len(own) // PIVOTS))]
    dense = np.zeros(n_terms)
    cosines = np.zeros((len(own), max(1, len(pivots))))
    for column, pivot in enumerate(pivots):
        terms, weights = vectors[pivot]
        dense[terms] = weights
        cosines[:, column] = [float(dense[vectors[i][0]] @ vectors[i][1]) for i in own]
        dense[terms] = 0
    order = sorted(range(len(own)), key=lambda at: (int(cosines[at].argmax()), -float(cosines[at].max()), at))
    return [own[at] for at in order]


@dataclass
class Model:
    """The examples' index, the vocabulary with its weights, and what turns votes into a score."""

    vocabulary: Vocabulary
    idf: np.ndarray
    index: Index
    keys: dict[int, str] = field(default_factory=dict)
    sizes: tuple[int, int] = (0, 0)
    knots: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(1), np.zeros(1)))
    blank: float = 0.0

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> Vector:
        weights = counts * self.idf[terms]
        return terms, weights / (math.sqrt(float(weights @ weights)) or 1.0)

    def share(self, near: list[list[tuple[float, int]]], own_label: int = -1) -> float | None:
        """The toxic share of the votes of the nearest of each label; None if nobody votes.

        Each label's votes are their mean over as many places as it has examples for.
        """
        means = []
        for label, found in enumerate(near):
            places = min(NEIGHBOURS, self.sizes[label] - (label == own_label))
            means.append(sum(c**POWER for c, _ in found) / max(places, 1))
        total = sum(means)
        return means[1] / total if total > 0 else None

    def scores(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, str]]:
        """The score of each text by the counts of its terms, and its three nearest examples as ``key:label:cosine``."""
        known = [at for at, (terms, _) in enumerate(counted) if len(terms)] if all(self.sizes) else []
        near = dict(zip(known, self.index.nearest([self.vector(*counted[at]) for at in known], NEIGHBOURS), strict=True))
        for at in range(len(counted)):
            share = self.share(near[at]) if at in near else None
            if share is None:
                yield self.blank, ""
                continue
            best = sorted((-c, slot, label) for label in (0, 1) for c, slot in near[at][label])[:3]
            evidence = ",".join(f"{self.keys[slot]}:{label}:{-c:.4f}" for c, slot, label in best)
            yield float(np.interp(share, *self.knots)), evidence


def isotonic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising curve that fits ``y`` best, each level drawn to ``prior`` by the weight of one row."""
    order = np.argsort(x, kind="stable")
    levels: list[list[float]] = []
    for a, b, w in zip(x[order], y[order], weights[order], strict=True):
        levels.append([float(b * w), float(w), float(a * w), float(a)])
        while len(levels) > 1 and (levels[-2][3] == levels[-1][3] or levels[-2][0] * levels[-1][1] >= levels[-1][0] * levels[-2][1]):
            last = levels.pop()
            levels[-1] = [p + q for p, q in zip(levels[-1][:3], last[:3], strict=True)] + [last[3]]
    at = np.array([s / w for _, w, s, _ in levels])
    return at, np.maximum.accumulate(np.array([(t + prior) / (w + 1) for t, w, _, _ in levels]))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES
) -> Model:
    """Learn from the labelled rows outside fold 0.

    At most ``examples`` rows of each class with a text of at most EXAMPLE_BYTES, those whose hashed key is least, are
    the examples; so what reaches the driver is bounded by these two numbers. Document frequencies of their terms are
    counted on all texts, class rates on all labelled rows. Rows with a NULL label or key teach nothing, a key
    with several labels is toxic if any is, one with several texts shows the least.
    """
    spark = docs.sparkSession
    given = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    given = given.where(fold(F.col(key)) != 0)
    sizes = {r["label"]: r["n"] for r in given.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    short = F.octet_length(text) <= EXAMPLE_BYTES
    able = docs.where(short).select(key).distinct().join(given, key)
    chosen = [able.where(F.col("label") == y).orderBy(F.xxhash64(key), F.col(key)).limit(examples) for y in (0, 1)]
    chosen = stage(chosen[0].unionByName(chosen[1]), "chosen")
    # At most twice `examples` keys.
    drawn = docs.where(short).select(key, text).join(F.broadcast(chosen.df), key)
    drawn = drawn.groupBy(key, "label").agg(F.min(text).alias(text))

    def make():
        def one(value, key_value, y):
            counts = term_counts(value)
            return str(key_value), y, " ".join(counts), np.array(list(counts.values()), np.int32).tobytes()

        return one

    rows = map_rows(drawn, [text, key, "label"], "id string, label int, terms string, counts binary", make).collect()
    release(spark, chosen.path)
    rows.sort(key=lambda r: (r["label"], r["id"]))
    vocabulary = Vocabulary()
    for r in rows:
        for term in r["terms"].split():
            vocabulary.setdefault(term, len(vocabulary))
    idf = inverse_frequencies(docs, text, vocabulary)
    vectors, kept = [], []
    model = Model(vocabulary, idf, Index([], [], len(vocabulary)))
    for r in rows:
        if r["terms"]:
            numbers = np.array([vocabulary[t] for t in r["terms"].split()])
            vectors.append(model.vector(numbers, np.frombuffer(r["counts"], np.int32)))
            kept.append(r)
    answers = [r["label"] for r in kept]
    model.index = Index(vectors, answers, len(vocabulary))
    model.keys = {int(slot): r["id"] for slot, r in zip(model.index.slots, kept, strict=True)}
    model.sizes = (answers.count(0), answers.count(1))
    weights = [sizes.get(y, 0) / max(1, sum(r["label"] == y for r in rows)) for y in (0, 1)]
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    blank = Counter(r["label"] for r in rows if not r["terms"])
    model.blank = (blank[1] * weights[1] + prior) / (blank[0] * weights[0] + blank[1] * weights[1] + 1)
    if all(model.sizes):
        shares = _shares_without_self(spark, model, vectors, answers)
        held = [(s, y) for s, y in zip(shares, answers, strict=True) if s is not None]
        if held:
            s, y = (np.array(v, float) for v in zip(*held, strict=True))
            model.knots = isotonic(s, y, np.array(weights)[y.astype(int)], prior)
    return model


def _shares_without_self(spark: SparkSession, model: Model, vectors: list[Vector], answers: list[int]) -> list[float | None]:
    """What the votes of the other examples say of each example."""
    ship(spark)
    given = spark.sparkContext.broadcast((model, vectors, answers))

    def make():
        model, vectors, answers = given.value

        def one(i):
            (near,) = model.index.nearest([vectors[i]], NEIGHBOURS, [int(model.index.slots[i])])
            return i, model.share(near, answers[i])

        return one

    rows = map_rows(spark.range(len(answers)), ["id"], "id long, share double", make).collect()
    given.destroy()
    return [share for _, share in sorted((r["id"], r["share"]) for r in rows)]


def inverse_frequencies(docs: DataFrame, text: str, vocabulary: Vocabulary) -> np.ndarray:
    """ln((1 + rows) / (1 + rows with the term)) + 1 over all texts, for each term of the vocabulary.

    One pass counts by term in each task; the sums are added up part by part.
    """
    spark = docs.sparkSession
    ship(spark)
    n = len(vocabulary)
    words = spark.sparkContext.broadcast(vocabulary)
    schema = "part int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        # The last place counts the rows themselves.
        sums = np.zeros(n + 1, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                values = batch.slice(start, SLICE_ROWS).column(0).to_pylist()
                held = [known.counts(value)[0] for value in values]
                sums[:n] += np.bincount(np.concatenate(held), minlength=n)[:n]
                sums[n] += len(values)
        parts = range(-(-(n + 1) // PART)) if sums[n] else []
        counts = [sums[p * PART : (p + 1) * PART].tobytes() for p in parts]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(counts, pa.binary())], ["part", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(value, np.int64) for value in rows["counts"])
        return pd.DataFrame({"part": rows["part"][:1], "counts": [total.tobytes()]})

    sums = np.zeros(n + 1, np.int64)
    for r in docs.select(text).mapInArrow(run, schema).groupBy("part").applyInPandas(add, schema).collect():
        found = np.frombuffer(r["counts"], np.int64)
        sums[r["part"] * PART : r["part"] * PART + len(found)] = found
    words.destroy()
    return np.log((1 + sums[n]) / (1 + sums[:n])) + 1


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, score (0 to 1), predicted (1 if score >= 0.5) and evidence of each text.

    A NULL or empty text, or one that shares no term with any example, has no neighbours: its score is the smoothed
    rate of toxic examples without words, its evidence empty. Texts are read whole, repeated rows give repeated
    results, an empty table an empty one, other columns are ignored. Without labels of both classes every text gets the
    base rate. Only the text enters a score. The result is written to the shared folder, after which the model leaves the
    executors.
    """
    spark = docs.sparkSession
    ship(spark)
    given = spark.sparkContext.broadcast(model)

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{kept}, score double, predicted int, evidence string"
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given.value
        for batch in batches:
            for start in range(0, batch.num_rows, QUERIES):
                part = batch.slice(start, QUERIES)
                found = list(model.scores([model.vocabulary.counts(value) for value in part.column(0).to_pylist()]))
                points = [s for s, _ in found]
                columns = [*part.columns[1:], points, [int(s >= 0.5) for s in points], [e for _, e in found]]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    scored = stage(docs.select(text, *keep).mapInArrow(run, schema), "scores")
    given.destroy()
    return scored.df


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, held_out, score, predicted and evidence of each row of ``docs``, learned from its labelled rows.

    Edge cases are as in `fit` and `score`; a row with a NULL key is not held out.
    """
    scored = score(docs, fit(docs, labels, key, text), text, (key,))
    held_out = F.coalesce(fold(F.col(key)) == 0, F.lit(False))
    return scored.select(key, held_out.alias("held_out"), "score", "predicted", "evidence")
