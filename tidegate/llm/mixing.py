"""Mixing sources to target weights by capped water-filling.

Each source gets a share of all words by its weight but at most ``cap`` times its own words; what a
capped source cannot take is shared among the others by weight until none is above its cap. A
source then repeats all its texts a whole number of times, and a seeded order of its texts decides
which of them serve the fractional rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.workspace import stage

WORD = r"[^\x20\x09-\x0D]+"
# The weights, repeating over the sources in order, and the most repetitions.
WEIGHTS, CAP = (5, 2, 1), 3
# The seeded order of a source's texts is cut into 16^3 parts, so that no task orders a whole source.
PART_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``target`` words of each source, from one row per ``source`` with its ``__name`` and ``source_size``.

    In order of ``cap * size / weight`` a source is capped where an equal level for it and all after it
    would exceed its cap. The windows pass one row per source through one task; texts never do.
    """
    ordered = totals.withColumn(
        "__rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("__weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("__cap") / F.col("__weight"), "__rank")
    so_far = fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        ordered.withColumn("__cap", cap * F.col("source_size"))
        .withColumn("__words", F.sum("source_size").over(everything))
        .withColumn("__weights", F.sum("__weight").over(everything))
        .withColumn("__left", F.col("__words") - F.coalesce(F.sum("__cap").over(so_far), F.lit(0)))
        .withColumn("__open", F.col("__weights") - F.coalesce(F.sum("__weight").over(so_far), F.lit(0)))
        .withColumn("__capped", F.col("__left") * F.col("__weight") >= F.col("__cap") * F.col("__open"))
    )
    # The first source below its cap sets the level of all that follow.
    level = F.first(F.when(~F.col("__capped"), F.struct("__left", "__open")), ignorenulls=True)
    levels = levels.withColumn("__level", level.over(fill.rowsBetween(Window.unboundedPreceding, 0)))
    share = F.col("__weight") * F.col("__level.__left") / F.col("__level.__open")
    target = F.when(F.col("__level").isNull(), F.col("__cap").cast("double")).otherwise(share)
    return levels.select("__name", "source", "source_size", target.alias("target"), F.col("__level").isNull().alias("__full"))


def allot(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    seed: int = 7,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``size``, ``source_size``, ``target`` and ``taken`` of each row of ``df``, with its key and the ``carry`` columns.

    ``taken`` counts words: the size times the source's whole repetitions, plus the row's part of the
    rest. The rest goes through the source's rows by the MD5 of seed and key, each whole, the last one
    in part, so a source's words add up to its target rounded down.

    A NULL text has size 0 and takes 0. A NULL source is a source of its own, the last. Rows with one
    key (or NULL) tie in the order and are served by size; equal rows share one result up to their
    order. If every source is capped, the mix is as large as the caps allow. An empty table gives an
    empty result. Columns other than the named ones are ignored.
    """
    order = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    rows = df.select(
        F.col(key).alias("__key"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        order.alias("__order"),
        # A name that is never NULL, so that the window and the join can share one shuffle.
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("__name"),
        *([F.struct(*carry).alias("__carry")] if carry else []),
    ).withColumn("__part", F.substring("__order", 1, PART_DIGITS))
    # Sizes are read several times but counted once; carried columns are not written for that.
    measured = stage(rows.drop("__carry"), "mixing").df
    parts = measured.groupBy("__name", "source", "__part").agg(F.sum("size").alias("__size"))
    # Parts of a source: 16^3 rows at most, whatever the source holds.
    before = Window.partitionBy("__name").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__name", "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    totals = parts.groupBy("__name", "source").agg(F.sum("__size").alias("source_size"))
    plan = starts.join(targets(totals, weights, cap).drop("source"), "__name")
    inside = Window.partitionBy("__name", "__part").orderBy("__order", "size")
    ahead = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.when(F.col("__full"), F.lit(cap)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    whole = F.when(F.col("source_size") > 0, whole).otherwise(0).cast("long")
    rest = F.when(F.col("__full"), F.lit(0)).otherwise(F.floor(F.col("target")) - F.col("__whole") * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("__rest") - F.col("__before") - F.col("__ahead")))
    taken = (
        (rows if carry else measured).withColumn("__ahead", ahead)
        .join(plan, ["__name", "__part"])
        .withColumn("__whole", whole)
        .withColumn("__rest", rest.cast("long"))
        .withColumn("taken", F.col("size") * F.col("__whole") + part)
    )
    kept = [F.col(f"__carry.{c}").alias(c) for c in carry]
    return taken.select(F.col("__key").alias(key), "size", "source_size", "target", "taken", *kept)


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mixed rows: each row of ``df`` as often as it is taken whole, then once with the first words
    of its text where it is taken in part. Rows that are not taken go; columns stay as they are.

    Rows without words carry nothing to mix and go. All else is as in `allot`.
    """
    columns = df.columns
    packed = df.select(
        F.col(key).alias("__id"), F.col(source).alias("__from"), F.col(text).alias("__text"), F.struct(*columns).alias("__row")
    )
    taken = allot(packed, "__id", "__from", "__text", carry=("__row",), **options).where(F.col("taken") > 0)
    whole_text = F.col("__row").getField(text)
    left = (F.col("taken") % F.col("size")).cast("int")
    words = F.regexp_extract_all(whole_text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    copies = F.array_repeat(whole_text, (F.col("taken") / F.col("size")).cast("int"))
    first_words = F.array_join(F.slice(words, F.lit(1), left), "")
    texts = F.when(left > 0, F.concat(copies, F.array(first_words))).otherwise(copies)
    out = taken.select("__row", F.explode(texts).alias("__copy"))
    return out.select(*[(F.col("__copy") if c == text else F.col("__row").getField(c)).alias(c) for c in columns])


def allot_sql() -> str:
    """DuckDB SQL for `allot` over ``documents``."""
    share = "w * l.left_words / l.open_weight"
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(concat_ws('-', '7', CAST(doc_id AS VARCHAR))) AS o
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS r
  FROM sized GROUP BY source),
levels AS (
  SELECT *, {CAP} * source_size AS c,
         CAST(sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER f, 0) AS BIGINT) AS left_words,
         CAST(sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS BIGINT) AS open_weight
  FROM totals WINDOW f AS (ORDER BY {CAP} * source_size / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT left_words, open_weight FROM levels
  WHERE left_words * w < c * open_weight ORDER BY c / w, r LIMIT 1),
goals AS (
  SELECT g.source, source_size, l.left_words IS NULL OR g.left_words * w >= g.c * g.open_weight AS capped,
         CASE WHEN l.left_words IS NULL OR g.left_words * w >= g.c * g.open_weight THEN CAST(g.c AS DOUBLE)
              ELSE {share} END AS target
  FROM levels g LEFT JOIN level l ON true),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.capped,
         CASE WHEN g.source_size = 0 THEN 0 WHEN g.capped THEN {CAP}
              ELSE CAST(floor(g.target / g.source_size) AS BIGINT) END AS whole,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.o, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * whole + CASE WHEN capped THEN 0 ELSE
         greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * source_size - ahead)) END AS BIGINT) AS taken
FROM placed"""
