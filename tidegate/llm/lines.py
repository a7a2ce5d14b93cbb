"""Line dedup: later copies of repeated line runs are deleted.

Texts are sequences of line ids. Prefix doubling ranks all suffixes of all sequences by their first 1, 2, 4, ...
lines, each round from the pairs of ranks of the round before; suffixes whose beginning occurs once
leave the rounds. Only intervals whose longest common prefix reaches ``min_words`` words matter, so the rounds
end at the depth that tells those apart, at most log2(min_words) whatever the corpus. Within such an interval
of the suffix array the earliest place stays and all others are deleted.

A maximal repeated run is the union of the shortest stretches of ``min_words`` words from each of its lines on, and
up to each of its lines. So an interval is looked up for each such stretch: a stretch of n lines, 2^k <= n <
2^(k+1), is known by the ranks of its first and of its last 2^k lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.membership import spread_join
from tidegate.workspace import Staged, release, stage

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50


def identity(key: str, text: str) -> Column:
    """Sixteen bytes that stand for a key and its text. The key's length parts the two, and marks a NULL."""
    name = F.col(key).cast("string")
    length = F.coalesce(F.octet_length(name).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat_ws(":", length, F.coalesce(name, F.lit("")), F.col(text)).cast("binary")))


def sequences(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line that has words: ``row``, ``key``, ``o`` (its number in the text), id (``h``, ``g``), ``w`` words."""
    texts = df.where(F.col(text).isNotNull()).select(
        identity(key, text).alias("row"), F.col(key).alias("key"), F.split(F.col(text), "\n", -1).alias("__lines")
    )
    lines = texts.select("row", "key", F.posexplode("__lines").alias("o", "line"))
    lines = lines.select(
        "row",
        "key",
        "o",
        F.xxhash64("line").alias("h"),
        # The seed first: were it last, this hash would follow from the other, and lines that share one would share both.
        F.xxhash64(F.lit(1), "line").alias("g"),
        F.regexp_count("line", F.lit(WORD)).alias("w"),
    )
    return lines.where("w > 0")


def ranked(groups: DataFrame, *keys: str) -> DataFrame:
    """``groups`` in the order of ``keys`` with a rank that ascends in that order.

    Rows are sorted by range; a rank is the number of the range and the place in it, so no task counts
    beyond its own rows. The ranks are written, so they stay as they are.
    """
    return _ranked(groups, *keys).df


def _ranked(groups: DataFrame, *keys: str) -> Staged:
    return stage(groups.orderBy(*keys).select(*keys, F.monotonically_increasing_id().alias("rank")), "ranks")


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys)


def stretches(shared: DataFrame, min_words: int) -> DataFrame:
    """The stretches of shared, consecutive lines that just reach ``min_words`` words: row, key, j, n, first, last.

    ``first`` and ``last`` are the lines of the text from and up to (exclusive) which a stretch reaches.
    """
    line = F.struct("j", "w", "first", "last")
    rows = shared.groupBy("row", "key").agg(F.array_sort(F.collect_list(line)).alias("lines"))

    def reach(lines: Column, start: Column, back: bool) -> Column:
        """Lines from ``start`` on (or back) until there are enough words; 0 if the run ends before."""
        taken = F.slice(lines, start, min_words)
        if back:
            taken = F.reverse(F.slice(lines, F.greatest(F.lit(1), start - min_words + 1), F.least(start, F.lit(min_words))))
        zero = F.lit(0)
        begin = F.struct(zero.alias("words"), zero.alias("n"), F.get(lines, start - 1).getField("j").alias("j"))

        def step(seen: Column, one: Column) -> Column:
            goes_on = (seen.getField("words") < min_words) & (one.getField("j") == seen.getField("j"))
            moved = F.struct(
                (seen.getField("words") + one.getField("w")).alias("words"),
                (seen.getField("n") + 1).alias("n"),
                (seen.getField("j") + (-1 if back else 1)).alias("j"),
            )
            return F.when(goes_on, moved).otherwise(seen)

        return F.aggregate(
            taken, begin, step, lambda seen: F.when(seen.getField("words") >= min_words, seen.getField("n")).otherwise(0)
        )

    def found(lines: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(lines))
        ahead = F.transform(places, lambda p: F.struct(p.alias("p"), reach(lines, p, False).alias("n")))
        behind = F.transform(places, lambda p: F.struct(p.alias("e"), reach(lines, p, True).alias("n")))
        behind = F.transform(behind, lambda s: F.struct((s.getField("e") - s.getField("n") + 1).alias("p"), s.getField("n").alias("n")))
        return F.array_distinct(F.filter(F.concat(ahead, behind), lambda s: s.getField("n") > 0))

    each = rows.select("row", "key", "lines", F.explode(found(F.col("lines"))).alias("s"))
    begin, end = F.get("lines", F.col("s.p") - 1), F.get("lines", F.col("s.p") + F.col("s.n") - 2)
    return each.select(
        "row",
        "key",
        begin.getField("j").alias("j"),
        F.col("s.n").alias("n"),
        begin.getField("first").alias("first"),
        end.getField("last").alias("last"),
    )


def later_copies(df: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """``row`` and ``cuts``, the sorted stretches (first, last) of lines of it that occur earlier in the corpus.

    The tables of a round are let go of once those of the next are written.
    """
    spark = df.sparkSession
    lines = stage(sequences(df, key, text).distinct(), "lines")
    by_id = ["h", "g"]
    ranks = _ranked(repeated(lines.df, *by_id), *by_id)
    # The lines of a text that have words, numbered; a line's region includes the wordless lines after it.
    within = Window.partitionBy("row").orderBy("o")
    numbered = lines.df.select(
        "*",
        (F.row_number().over(within) - 1).alias("j"),
        F.coalesce(F.lead("o").over(within), F.lit(2**31 - 1)).alias("last"),
    ).withColumn("first", F.when(F.col("j") == 0, 0).otherwise(F.col("o")))
    shared = stage(spread_join(numbered, ranks.df, by_id, "inner").drop("h", "g", "o"), "shared")
    release(spark, lines.path, ranks.path)
    wanted = stage(stretches(shared.df, min_words), "stretches", F.max("n").alias("longest"))
    longest = wanted.metrics["longest"] or 0

    suffixes, depth = shared.df.select("row", "j", "rank"), 1
    cuts, used = [], [shared.path]
    while depth <= longest:
        known = (F.col("n") >= depth) & (F.col("n") < 2 * depth)
        begins = suffixes.withColumnRenamed("rank", "a")
        ends = suffixes.select("row", F.col("j").alias("__e"), F.col("rank").alias("b"))
        placed = (
            wanted.df.where(known)
            .withColumn("__e", F.col("j") + F.col("n") - depth)
            .join(begins, ["row", "j"])
            .join(ends, ["row", "__e"])
        )
        # An interval of the suffix array: the places that share n lines. The least place stays.
        place = F.struct("key", "row", "j")
        interval = placed.groupBy("n", "a", "b").agg(F.min(place).alias("__kept"), F.count(F.lit(1)).alias("__n"))
        later = spread_join(placed, interval.where("__n > 1").drop("__n"), ["n", "a", "b"], "inner")
        cuts.append(stage(later.where(F.col("__kept") != place).select("row", "first", "last"), "cuts"))
        if 2 * depth <= longest:
            following = suffixes.select("row", (F.col("j") - depth).alias("j"), F.col("rank").alias("next"))
            pairs = stage(suffixes.withColumnRenamed("rank", "begin").join(following, ["row", "j"]), "pairs")
            doubled = _ranked(repeated(pairs.df, "begin", "next"), "begin", "next")
            joined = spread_join(pairs.df, doubled.df, ["begin", "next"], "inner").select("row", "j", "rank")
            new = stage(joined, "suffixes")
            release(spark, pairs.path, doubled.path, *used)
            suffixes, used = new.df, [new.path]
        depth *= 2
    found = [c.df for c in cuts] or [wanted.df.select("row", "first", "last")]
    result = stage(merged(reduce(DataFrame.unionByName, found)), "merged")
    release(spark, wanted.path, *used, *[c.path for c in cuts])
    return result.df


def merged(cuts: DataFrame) -> DataFrame:
    """``row`` and its ``cuts``, sorted, those that overlap or touch made one."""
    in_order = Window.partitionBy("row").orderBy("first", "last")
    before = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("first") > before, F.lit(True)).cast("int")
    numbered = cuts.withColumn("__new", apart).withColumn("__run", F.sum("__new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("row", "__run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("cuts"))


def kept_lines(lines: Column, cuts: Column) -> Column:
    """The lines outside the sorted ``cuts``, of which no two overlap: those between each cut and the one before, and the rest."""
    ends = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: F.least(c.getField("last"), F.size(lines))))
    begins = F.concat(F.transform(cuts, lambda c: c.getField("first")), F.array(F.size(lines)))
    gaps = F.arrays_zip(ends.alias("first"), begins.alias("last"))
    parts = F.transform(
        gaps, lambda g: F.slice(lines, g.getField("first") + 1, F.greatest(F.lit(0), g.getField("last") - g.getField("first")))
    )
    return F.flatten(parts)


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with the lines of each text that are later copies deleted, and with ``n_lines`` and ``n_deleted``.

    A run is a sequence of consecutive lines, equal byte for byte, of together ``min_words`` words or more. Of
    its places the first one by key (NULL first), then by line, stays. Lines without words count to the line
    before them, at the beginning to the line after them; between two lines of a run they may differ.

    A NULL text stays NULL with 0 lines; an empty one has one line and stays. Rows with equal key and text are
    one document and share its result. A text all of whose lines go becomes empty. Runs may overlap and may lie
    in one text. An empty table gives an empty result. ``n_lines`` and ``n_deleted`` replace columns so named;
    other columns stay.
    """
    others = [c for c in df.columns if c not in ("n_lines", "n_deleted")]
    cuts = later_copies(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text", min_words)
    marked = df.select(
        identity(key, text).alias("row"), F.col(text).alias("text"), F.struct(*others).alias("given")
    )
    # Texts meet their cuts by shuffle whatever the size of the cuts, which grow with the corpus.
    joined = marked.join(cuts.hint("shuffle_merge"), "row", "left").withColumn("lines", F.when(F.col("text").isNotNull(), F.split("text", "\n", -1)))
    counted = joined.withColumn("kept", F.when(F.col("cuts").isNotNull(), kept_lines(F.col("lines"), F.col("cuts"))))
    changed = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("text"))
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    n_kept = F.when(F.col("kept").isNull(), n_lines).otherwise(F.size("kept"))
    return counted.select(
        *[(changed if c == text else F.col("given").getField(c)).alias(c) for c in others],
        n_lines.cast("long").alias("n_lines"),
        (n_lines - n_kept).cast("long").alias("n_deleted"),
    )


def dedup_sql(min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL for doc_id, n_lines, n_deleted and text of `dedup` over ``documents``."""
    return f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS o FROM d WHERE text IS NOT NULL),
w AS (
  SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM l),
s AS (
  SELECT doc_id, o, line, w, row_number() OVER p - 1 AS j, sum(w) OVER p AS c,
         coalesce(lead(o) OVER p, 2147483647) AS last FROM w WHERE w > 0
  WINDOW p AS (PARTITION BY doc_id ORDER BY o)),
f AS (
  SELECT a.doc_id, a.j, min(b.j) AS e FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.j BETWEEN a.j AND a.j + {min_words}
    AND b.c - a.c + a.w >= {min_words} GROUP BY a.doc_id, a.j
  UNION
  SELECT b.doc_id, max(a.j) AS j, b.j AS e FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.j BETWEEN b.j - {min_words} AND b.j
    AND b.c - a.c + a.w >= {min_words} GROUP BY b.doc_id, b.j),
t AS (
  SELECT f.doc_id, f.j, f.e, md5(string_agg(line, chr(10) ORDER BY s.j)) AS content, min(CASE WHEN s.j = 0 THEN 0 ELSE o END) AS first,
         max(last) AS last
  FROM f JOIN s ON f.doc_id = s.doc_id AND s.j BETWEEN f.j AND f.e GROUP BY f.doc_id, f.j, f.e),
r AS (SELECT *, row_number() OVER (PARTITION BY content, e - j ORDER BY doc_id, j) AS n FROM t),
x AS (SELECT DISTINCT l.doc_id, l.o FROM l JOIN r ON l.doc_id = r.doc_id AND r.n > 1 AND l.o >= r.first AND l.o < r.last),
k AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.o) FILTER (x.o IS NULL) AS kept, count(*) AS n_lines, count(x.o) AS n_deleted
  FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.o = x.o GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""
