"""Secret scan with corpus-wide ownership frequency.

Candidates are found by pattern in each text. Their hashes are then counted over the whole corpus by
distinct repositories and owners: a value that many owners hold was copied from an example, one
that a single owner holds looks live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.membership import spread_join
from tidegate.workspace import stage

# A value held by so many owners counts as a copied example.
EXAMPLE_OWNERS = 3


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the value, and the value's least length."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), f"{either_case('api')}_?{either_case('key')}"])

# The base kinds, in the order of their names in results.
BASE = (
    Kind("assign", rf"({NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16),
    Kind("hex", r"[0-9a-f]{32,}"),
)
# Further formats of credentials.
MORE = (
    Kind("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Kind("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\n\r]*-----END [A-Z ]*PRIVATE KEY-----"),
    Kind("google", r"AIza[A-Za-z0-9_-]{35}"),
    Kind("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Kind("sendgrid", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Kind("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Kind("npm", r"npm_[A-Za-z0-9]{36}"),
)
KINDS = BASE + MORE


MATCHES = "array<struct<rank: int, i: int, gap: int, size: int, value: string>>"


def matches(text: Column, kind: Kind, rank: int) -> Column:
    """Array of the matches of one kind, leftmost and not overlapping: the number of each, the code points between it and
    the one before, its own, and the digest of its value; none if the value is too short."""
    found = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("match")
    )

    def one(item: Column, number: Column) -> Column:
        match = item.getField("match")
        value = F.regexp_extract(match, kind.pattern, kind.group) if kind.group else match
        digest = F.when(F.length(value) >= kind.least, F.sha2(value.cast("binary"), 256))
        gap, size = F.length(item.getField("piece")), F.length(match)
        return F.struct(F.lit(rank).alias("rank"), number.alias("i"), gap.alias("gap"), size.alias("size"), digest.alias("value"))

    return F.transform(F.filter(found, lambda item: item.getField("match").isNotNull()), one)


def candidates(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """Array of the matches of all kinds. Texts without any take the short way."""
    nothing = F.array().cast(MATCHES)
    each = [F.when(text.rlike(kind.pattern), matches(text, kind, rank)).otherwise(nothing) for rank, kind in enumerate(kinds)]
    return F.when(text.rlike("|".join(f"(?:{k.pattern})" for k in kinds)), F.concat(*each)).otherwise(nothing)


def places_of(found: DataFrame) -> DataFrame:
    """start, rank, end and value of each candidate of the ``__found`` of a ``__row``.

    Matches follow each other, so where one ends is a running sum over those before it: a sort of the matches of a text and
    kind, whose time grows with their number and which spills where they are many.
    """
    each = found.select("__row", "__owner", "__repository", F.explode("__found").alias("m")).select("__row", "__owner", "__repository", "m.*")
    so_far = Window.partitionBy("__row", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int")
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    return placed.where(F.col("value").isNotNull()).select("__row", "__owner", "__repository", "start", "rank", "end", "value")


def joined(found: Column, kinds: tuple[Kind, ...]) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in kinds])
    one = lambda s: F.concat_ws(":", F.get(names, s.getField("rank")), s.getField("start"), s.getField("end"))
    return F.array_join(F.transform(found, one), ",")


def scan(
    df: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    keep: tuple[str, ...] = ("doc_id",),
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """Secrets of each text.

    Result: the ``keep`` columns, n_assign, n_access, n_hex, base_sha256 and spans (base spans and those of the
    other kinds that are no copied examples), then n_live and n_example (candidates whose value one owner
    holds, and at least ``example_owners``), most_owners and most_repositories.

    A NULL or empty text has no candidates. A NULL owner or repository counts as one of its own.
    Repeated rows give repeated results and count once as owner and repository. An empty table gives an
    empty result. Any length of text is read whole. Columns other than the named ones are ignored.

    A value's places are folded by owner and repository before they meet, and the join back to the places splits
    a value that a third of them hold, so no task holds all places of a value.
    """
    given = df.select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
        F.coalesce(F.concat(F.lit("="), F.col(owner).cast("string")), F.lit("")).alias("__owner"),
        F.coalesce(F.concat(F.lit("="), F.col(repository).cast("string")), F.lit("")).alias("__repository"),
        F.coalesce(F.col(text), F.lit("")).alias("__text"),
    )
    found = given.withColumn("__found", candidates(F.col("__text"))).drop("__text")
    # Written once: the row numbers stay as they are and texts are read only here.
    found = stage(found.withColumn("__row", F.monotonically_increasing_id()), "secrets").df
    places = places_of(found)
    held = places.groupBy("value", "__owner", "__repository").agg(F.lit(1).alias("__n"))
    by_owner = held.groupBy("value", "__owner").agg(F.count("__n").alias("__repositories"))
    owners = by_owner.groupBy("value").agg(
        F.count("__repositories").alias("__owners"), F.sum("__repositories").alias("__repositories")
    )
    judged = spread_join(places.drop("__owner", "__repository"), owners, ["value"], "inner")
    span = F.struct("start", "rank", "end", F.col("__owners").alias("owners"), F.col("__repositories").alias("repositories"))
    by_row = judged.groupBy("__row").agg(F.array_sort(F.collect_list(span)).alias("__judged"))
    result = found.join(by_row, "__row", "left")
    nothing = F.expr("CAST(array() AS array<struct<start: int, rank: int, end: int, owners: bigint, repositories: bigint>>)")
    judged_spans = F.coalesce(F.col("__judged"), nothing)
    base = F.filter(judged_spans, lambda s: s.getField("rank") < len(BASE))
    shown = F.filter(judged_spans, lambda s: (s.getField("rank") < len(BASE)) | (s.getField("owners") < example_owners))

    def counted(condition) -> Column:
        return F.size(F.filter(judged_spans, condition)).cast("long")

    def of_rank(rank: int):
        return lambda s: s.getField("rank") == rank

    return result.select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)],
        *[counted(of_rank(rank)).alias(f"n_{kind.name}") for rank, kind in enumerate(BASE)],
        F.sha2(joined(base, KINDS).cast("binary"), 256).alias("base_sha256"),
        joined(shown, KINDS).alias("spans"),
        counted(lambda s: s.getField("owners") == 1).alias("n_live"),
        counted(lambda s: s.getField("owners") >= example_owners).alias("n_example"),
        F.coalesce(F.array_max(F.transform(judged_spans, lambda s: s.getField("owners"))), F.lit(0)).alias("most_owners"),
        F.coalesce(F.array_max(F.transform(judged_spans, lambda s: s.getField("repositories"))), F.lit(0)).alias(
            "most_repositories"
        ),
    )


def scan_sql() -> str:
    """DuckDB SQL for `scan` over ``documents``."""
    quoted = lambda p: p.replace("'", "''")
    matches = " UNION ALL ".join(
        f"""SELECT r, source, doc_id, {rank} AS k, '{kind.name}' AS kind, {kind.least} AS least,
  unnest(list_zip(string_split_regex(t, '{quoted(kind.pattern)}'), regexp_extract_all(t, '{quoted(kind.pattern)}'),
    regexp_extract_all(t, '{quoted(kind.pattern)}', {kind.group}),
    range(len(string_split_regex(t, '{quoted(kind.pattern)}'))))) AS z FROM d WHERE regexp_matches(t, '{quoted(kind.pattern)}')"""
        for rank, kind in enumerate(KINDS)
    )
    counts = ", ".join(f"coalesce(count(*) FILTER (k = {rank}), 0) AS n_{kind.name}" for rank, kind in enumerate(BASE))
    name = "kind || ':' || beg || ':' || fin"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS (SELECT r, source, doc_id, k, kind, least, z[1] AS piece, z[2] AS found, z[3] AS value, z[4] AS i FROM ({matches})),
p AS (
  SELECT *, sum(length(piece) + coalesce(length(found), 0)) OVER (PARTITION BY r, k ORDER BY i) AS stop_sum FROM m),
s AS (
  SELECT r, source, doc_id, k, kind, value, CAST(stop_sum AS BIGINT) AS fin, CAST(stop_sum - length(found) AS BIGINT) AS beg
  FROM p WHERE found IS NOT NULL AND length(value) >= least),
o AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repositories FROM s GROUP BY value),
g AS (
  SELECT r, {counts},
         sha256(coalesce(string_agg({name}, ',' ORDER BY beg, k) FILTER (k < {len(BASE)}), '')) AS base_sha256,
         coalesce(string_agg({name}, ',' ORDER BY beg, k) FILTER (k < {len(BASE)} OR owners < {EXAMPLE_OWNERS}), '') AS spans,
         count(*) FILTER (owners = 1) AS n_live, count(*) FILTER (owners >= {EXAMPLE_OWNERS}) AS n_example,
         max(owners) AS most_owners, max(repositories) AS most_repositories
  FROM s JOIN o USING (value) GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{kind.name}, 0) AS n_{kind.name}" for kind in BASE)},
       coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
       coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
FROM d LEFT JOIN g USING (r)"""
