"""Secret scanning with corpus-wide ownership of the values found, in column expressions only.

Base findings are the leftmost, non-overlapping matches of three patterns: assignments of a value to a name such as
``token``, access keys and long hexadecimal strings. The method looks at the values: each value found by a base pattern,
or by the general pattern for long mixed tokens, is hashed, and over the whole corpus the distinct repositories, owners
and texts of each hash are counted. A value of at most ``live_owners`` owners in at most ``live_repositories``
repositories and ``live_texts`` different texts is an owner-specific, live-looking credential; any other is a widely
copied example.

Long tokens that overlap no base finding become findings of kind ``live`` if their value is owner-specific. Base findings
always stay; n_live counts the added findings, n_copied the base findings with a widely copied value.

Positions count code points. Rules: a null text counts as empty. A null owner or repository is a value of its own.
Repeated rows are scanned alike and count once per owner and repository. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmart.llm.tables import stage_numbered
from moodmart.operators.joins import dimension_join
from moodmart.session import stage

# The patterns of the contract, in the order of the kinds
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
ASSIGN_MIN_CHARS = 6
# Added by the method: a long token of the characters of an assigned value, with letters and digits; a full stop does not
# end it
LONG_TOKEN = r"[A-Za-z0-9+/_-][A-Za-z0-9+/_.=-]{18,}[A-Za-z0-9+/_=-]"
LIVE_OWNERS = 1
LIVE_REPOSITORIES = 2
LIVE_TEXTS = 4

KINDS = ("assign", "access", "hex", "live")


_PATTERNS = ((ASSIGN, 2), (ACCESS, 0), (HEX, 0), (LONG_TOKEN, 0))


def _matches(text: Column, pattern: str, kind: int, value_group: int) -> Column:
    """The lengths of all matches and of the pieces around them, and the matched values; null without a match.

    Splitting by the pattern gives the pieces between matches. Texts without a match cost one search.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(
        text.rlike(pattern),
        F.struct(
            F.lit(kind).alias("kind"),
            F.transform(F.split(text, pattern, -1), F.char_length).alias("before"),
            F.transform(whole, F.char_length).alias("length"),
            values.alias("value"),
        ),
    )


def find_secrets(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    live_owners: int = LIVE_OWNERS,
    live_repositories: int = LIVE_REPOSITORIES,
    live_texts: int = LIVE_TEXTS,
) -> tuple[DataFrame, DataFrame]:
    """Scan ``docs`` (doc_id, text); ``owner`` and ``repository`` are columns of it.

    Returns a row per document (rid, doc_id), and the findings (rid, kind, start, end, value, owners, repositories,
    texts, live): those of the base kinds and the added ones.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.array_compact(
        F.array(*[_matches(text, pattern, kind, group) for kind, (pattern, group) in enumerate(_PATTERNS)])
    )
    scanned = stage_numbered(
        docs.select(
            "doc_id",
            owner.cast("string").alias("owner"),
            repository.cast("string").alias("repository"),
            F.xxhash64(text).alias("text_hash"),
            found.alias("found"),
        )
    )
    pieces = (
        scanned.select("rid", "owner", "repository", "text_hash", F.explode("found").alias("found"))
        .select(
            "rid", "owner", "repository", "text_hash", "found.kind",
            F.posexplode(F.arrays_zip("found.before", "found.length", "found.value")).alias("place", "piece"),
        )
        .select("rid", "owner", "repository", "text_hash", "kind", "place", "piece.*")
        .where(F.col("length").isNotNull())
    )
    in_order = Window.partitionBy("rid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("end", F.sum(F.col("before") + F.col("length")).over(in_order)).withColumn(
        "start", F.col("end") - F.col("length")
    )
    long_enough = (F.col("kind") != 0) | (F.char_length("value") >= ASSIGN_MIN_CHARS)
    mixed = (F.col("kind") != 3) | (F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"))
    base = F.col("kind") < 3
    so_far = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    to_come = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(0, Window.unboundedFollowing)
    candidates = stage(
        placed.where(long_enough & mixed)
        .withColumn("behind", F.max(F.when(base, F.col("end"))).over(so_far))
        .withColumn("ahead", F.min(F.when(base, F.col("start"))).over(to_come))
        .where(base | (F.coalesce(F.col("behind") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True))))
        .select(
            "rid", "owner", "repository", "text_hash", "kind", "start", "end", "value", F.sha2("value", 256).alias("hash")
        )
    )
    uses = candidates.select("hash", "owner", "repository").distinct()
    owners = uses.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    repositories = uses.groupBy("hash").agg(F.count(F.lit(1)).alias("repositories"))
    texts = candidates.select("hash", "text_hash").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("texts"))
    ownership = stage(owners.join(repositories, "hash").join(texts, "hash"))
    findings = (
        dimension_join(candidates, ownership, "hash")
        .withColumn(
            "live",
            (F.col("owners") <= live_owners)
            & (F.col("repositories") <= live_repositories)
            & (F.col("texts") <= live_texts),
        )
        .where(base | F.col("live"))
        .select("rid", "kind", "start", "end", "value", "owners", "repositories", "texts", "live")
    )
    return scanned.select("rid", "doc_id"), findings


def digest(documents: DataFrame, findings: DataFrame) -> DataFrame:
    """Per document the numbers of findings and their places, as text and as a hash."""

    def written(spans: Column) -> Column:
        names = F.array(*[F.lit(kind) for kind in KINDS])
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def number(condition: Column) -> Column:
        return F.sum(condition.cast("long"))

    per_document = findings.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        *[number(F.col("kind") == kind).alias(f"n_{KINDS[kind]}") for kind in range(4)],
        number((F.col("kind") < 3) & ~F.col("live")).alias("n_copied"),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    spans = F.coalesce(F.col("all"), none)
    return (
        documents.join(per_document, "rid", "left")
        .withColumn("all", spans)
        .select(
            "doc_id",
            *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
            F.sha2(written(F.filter("all", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
            written(F.col("all")).alias("spans"),
            *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_live", "n_copied")],
        )
    )
