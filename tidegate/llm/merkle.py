"""Document fingerprints as Merkle trees.

A text is cut into sections (at blank lines), paragraphs (at line ends) and leaves (sentences, long ones in
stretches of 64 characters). Leaves are hashed, and each paragraph, section and the root is the hash
of its children's hashes. Equal roots mean equal texts; where roots differ, only differing branches have
to be followed to find the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.workspace import stage

# Sentences with their end marks, in stretches of at most 64 characters; together the whole paragraph.
LEAF = r"[^.!?]{0,64}[.!?]+|[^.!?]{1,64}"
SECTION, PARAGRAPH = "\n\n", "\n"
# Hexadecimal digits of inner nodes and of leaves in a fingerprint; the root has all 32.
NODE_DIGITS, LEAF_DIGITS = 16, 8


def tree(text: Column) -> Column:
    """Sections of paragraphs of leaf hashes: array<array<array<string>>>."""

    def leaves(paragraph: Column) -> Column:
        found = F.regexp_extract_all(paragraph, F.lit(LEAF), F.lit(0))
        return F.transform(found, lambda leaf: F.md5(leaf.cast("binary")))

    def paragraphs(section: Column) -> Column:
        return F.transform(F.split(section, PARAGRAPH, -1), leaves)

    return F.transform(F.split(text, SECTION, -1), paragraphs)


def node(children: Column) -> Column:
    return F.md5(F.array_join(children, "").cast("binary"))


def fingerprint(hashes: Column) -> Column:
    """``root/section.paragraph-leaf-leaf.paragraph.../section...`` of a `tree`."""

    def paragraph(leaves: Column) -> Column:
        marks = F.transform(leaves, lambda leaf: F.concat(F.lit("-"), F.left(leaf, F.lit(LEAF_DIGITS))))
        return F.concat(F.lit("."), F.left(node(leaves), F.lit(NODE_DIGITS)), F.array_join(marks, ""))

    def section(paragraphs: Column) -> Column:
        own = F.left(node(F.transform(paragraphs, node)), F.lit(NODE_DIGITS))
        return F.concat(F.lit("/"), own, F.array_join(F.transform(paragraphs, paragraph), ""))

    root = node(F.transform(hashes, lambda paragraphs: node(F.transform(paragraphs, node))))
    return F.concat(root, F.array_join(F.transform(hashes, section), ""))


def leaf_set(mark: Column) -> Column:
    """Distinct leaves of a fingerprint."""
    return F.array_distinct(F.transform(F.filter(F.split(mark, "(?=[-./])"), lambda p: p.startswith("-")), lambda p: F.substring(p, 2, LEAF_DIGITS)))


def likeness(mark: Column, other: Column, leaves: Column, other_leaves: Column) -> Column:
    """1 for equal roots, else the share of distinct leaves that both fingerprints hold."""
    both = F.size(F.array_intersect(leaves, other_leaves))
    either = F.size(leaves) + F.size(other_leaves) - both
    shared = F.when(either > 0, both / either).otherwise(F.lit(0.0))
    return F.when(F.left(mark, F.lit(32)) == F.left(other, F.lit(32)), F.lit(1.0)).otherwise(shared)


def branches(mark: Column) -> Column:
    """Hashes of a fingerprint by level: sections, and within them paragraphs with their leaves."""
    sections = F.filter(F.split(F.substring(mark, 33, 2**31 - 1), "/", -1), lambda s: s != "")
    return F.transform(sections, lambda s: F.split(s, r"\.", -1))


def edits(mark: Column, other: Column) -> Column:
    """Places ``section.paragraph.leaf`` (from 0) at which two fingerprints differ, branch by branch.

    Branches with equal hashes are not entered. Places beyond the end of one tree count as differing.
    """
    none = F.array().cast("array<string>")

    def named(prefix: Column, places: Column) -> Column:
        return F.transform(places, lambda p: F.concat(prefix, F.lit("."), p))

    def leaf_places(a: Column, b: Column) -> Column:
        pairs = F.arrays_zip(F.split(a, "-", -1).alias("a"), F.split(b, "-", -1).alias("b"))
        differ = F.transform(pairs, lambda p, i: F.when(p["a"].eqNullSafe(p["b"]), F.lit(None)).otherwise((i - 1).cast("string")))
        return F.filter(differ, lambda p: p.isNotNull() & (p != "-1"))

    def paragraph_places(a: Column, b: Column) -> Column:
        pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
        found = F.transform(
            pairs,
            lambda p, i: F.when(p["a"].eqNullSafe(p["b"]) | (i == 0), none).otherwise(
                named((i - 1).cast("string"), leaf_places(F.coalesce(p["a"], F.lit("")), F.coalesce(p["b"], F.lit(""))))
            ),
        )
        return F.flatten(found)

    pairs = F.arrays_zip(branches(mark).alias("a"), branches(other).alias("b"))
    nothing = F.array(F.lit(""))
    found = F.transform(
        pairs,
        lambda p, i: F.when(p["a"].eqNullSafe(p["b"]), none).otherwise(
            named(i.cast("string"), paragraph_places(F.coalesce(p["a"], nothing), F.coalesce(p["b"], nothing)))
        ),
    )
    return F.flatten(found)


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each text in ``out``. A NULL text counts as empty."""
    return df.withColumn(out, fingerprint(tree(F.coalesce(F.col(text), F.lit("")))))


def following(ids: DataFrame, key: str) -> DataFrame:
    """``ids``, which has one row per ``key``, with ``__next``: the next key in ascending order (NULL first), as
    a struct of one field; the first key after the last.

    Keys are dealt by range and written with the number of their part; within a part a window finds the next
    key, and the first keys of the parts, one row per part, close the gaps between parts.
    """
    placed = ids.repartitionByRange(F.col(key).asc_nulls_first()).withColumn("__part", F.spark_partition_id())
    placed = stage(placed, "following").df
    inside = Window.partitionBy("__part").orderBy(F.col(key).asc_nulls_first())
    own = F.struct(F.col(key).alias("id"))
    heads = placed.groupBy("__part").agg(F.min(own).alias("__head"))
    parts = Window.orderBy("__part")
    everything = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        "__part", F.coalesce(F.lead("__head").over(parts), F.first("__head").over(everything)).alias("__after")
    )
    within = placed.withColumn("__next", F.lead(own).over(inside)).join(heads, "__part")
    return within.withColumn("__next", F.coalesce("__next", "__after")).drop("__part", "__after")


def name(value: Column) -> Column:
    """A key as text that is never NULL, so that NULL keys join like others."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last ``floor(n / 4)`` characters replaced by the first as many of the text of the
    next key. Result: ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    and next_id.

    A NULL text counts as empty. A NULL key comes first. Where several rows share the next key, the
    least of their texts' beginnings serves. A single key is followed by itself. Repeated rows give repeated
    results, an empty table an empty one, any length of text is read whole, other columns are ignored.

    Texts are shuffled once, by key: the rows are joined with the key that precedes them, and what the preceding
    text needs of them (a beginning and the leaves) goes there.
    """
    rows = df.select(
        F.col(key).alias("__id"), name(F.col(key)).alias("__name"), F.coalesce(F.col(text), F.lit("")).alias("__text")
    )
    lengths = rows.groupBy("__id").agg(F.max(F.length("__text")).alias("__longest"))
    links = following(lengths, "__id")
    before = links.select(
        name(F.col("__next.id")).alias("__name"), name(F.col("__id")).alias("__before"), "__longest"
    )
    needed = F.floor(F.col("__longest") / 4).cast("int")
    sent = rows.join(before, "__name").select(
        "__before", F.left("__text", needed).alias("head"), fingerprint(tree(F.col("__text"))).alias("mark"), "__id"
    )
    sent = sent.select(
        F.col("__before").alias("__name"), F.struct("head", F.col("mark").alias("mark"), F.col("__id").alias("id")).alias("next")
    )
    arrived = sent.groupBy("__name").agg(F.min("next").alias("__next"))
    quarter = F.floor(F.length("__text") / 4).cast("int")
    edited = F.concat(
        F.left("__text", F.length("__text") - quarter), F.left(F.col("__next.head"), quarter)
    )
    pairs = rows.join(arrived, "__name").select(
        F.col("__id").alias(key),
        F.length("__text").cast("long").alias("n_chars"),
        edited.alias("__edited"),
        fingerprint(tree(F.col("__text"))).alias("fingerprint"),
        F.col("__next.mark").alias("__next_mark"),
        F.col("__next.id").alias("next_id"),
    )
    marked = pairs.select(
        key,
        "n_chars",
        F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(tree(F.col("__edited"))).alias("edited_fingerprint"),
        "__next_mark",
        "next_id",
    )
    leaves = marked.select(
        "*",
        leaf_set(F.col("fingerprint")).alias("__leaves"),
        leaf_set(F.col("edited_fingerprint")).alias("__edited_leaves"),
        leaf_set(F.col("__next_mark")).alias("__next_leaves"),
    )
    own = F.col("fingerprint")
    return leaves.select(
        key,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint"), F.col("__leaves"), F.col("__edited_leaves")).alias("near_edited"),
        likeness(own, F.col("__next_mark"), F.col("__leaves"), F.col("__next_leaves")).alias("near_next"),
        "next_id",
    )


def compare_edited_sql() -> str:
    """DuckDB SQL for `compare_edited` over ``documents``."""

    def mark(tree: str) -> str:
        node = lambda x: f"md5(array_to_string({x}, ''))"
        paragraphs = lambda s: f"list_transform({s}, lambda p: {node('p')})"
        leaves = f"array_to_string(list_transform(p, lambda l: '-' || left(l, {LEAF_DIGITS})), '')"
        paragraph = f"'.' || left({node('p')}, {NODE_DIGITS}) || {leaves}"
        section = (
            f"'/' || left({node(paragraphs('s'))}, {NODE_DIGITS}) || array_to_string(list_transform(s, lambda p: {paragraph}), '')"
        )
        root = node(f"list_transform({tree}, lambda s: {node(paragraphs('s'))})")
        return f"{root} || array_to_string(list_transform({tree}, lambda s: {section}), '')"

    def hashes(text: str) -> str:
        leaf = f"list_transform(regexp_extract_all(p, '{LEAF}'), lambda l: md5(l))"
        paragraphs = f"list_transform(string_split(s, chr(10)), lambda p: {leaf})"
        return f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: {paragraphs})"

    def near(mark: str, leaves: str) -> str:
        both = f"len(list_intersect(own, {leaves}))"
        return (
            f"CASE WHEN left(fingerprint, 32) = left({mark}, 32) THEN 1.0::DOUBLE"
            f" WHEN len(own) + len({leaves}) > {both} THEN {both}::DOUBLE / (len(own) + len({leaves}) - {both})"
            f" ELSE 0.0::DOUBLE END"
        )

    leaf_list = lambda m: f"list_distinct(list_transform(regexp_extract_all({m}, '-[^-./]+'), lambda x: x[2:]))"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text
  FROM documents WINDOW w AS (ORDER BY doc_id NULLS FIRST)),
e AS (SELECT *, left(t, n - n // 4) || left(next_text, n // 4) AS edited FROM d),
h AS (SELECT *, {hashes("t")} AS own_tree, {hashes("edited")} AS edited_tree, {hashes("next_text")} AS next_tree FROM e),
f AS (
  SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, next_id, {mark("own_tree")} AS fingerprint,
         {mark("edited_tree")} AS edited_fingerprint, {mark("next_tree")} AS next_fingerprint FROM h),
l AS (
  SELECT *, {leaf_list("fingerprint")} AS own, {leaf_list("edited_fingerprint")} AS changed,
         {leaf_list("next_fingerprint")} AS following FROM f)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_id,
       {near("edited_fingerprint", "changed")} AS near_edited, {near("next_fingerprint", "following")} AS near_next
FROM l"""
