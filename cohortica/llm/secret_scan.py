"""Secrets in texts, told apart by who owns them across the whole corpus.

Three base patterns give the base spans. Two weaker patterns, keys with a vendor prefix and long
tokens of mixed characters, give further candidates. A candidate's value is reduced to a hash, and
the corpus says in how many distinct owners and repositories it occurs: what many owners hold is a
widely copied example, what few hold looks live. Weak candidates become spans of kind ``live`` only
if their value looks live, and base spans carry the same verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns. Letters of the names match in either case.
NAMES = (
    "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
)
ASSIGN_HEAD = rf"""(?:{NAMES})["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]+"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
VENDOR = "(?:gh[pousr]_|sk_live_|sk_test_|xox[abprs]-|AIza|glpat-|npm_)[A-Za-z0-9_-]{16,}"
TOKEN = "[A-Za-z0-9+/_-]{24,}"
ASSIGN_LEAST = 12

# In this many owners a value is an example that people copy.
COPIED_OWNERS = 3
COPIED_REPOSITORIES = 6


@dataclass(frozen=True)
class Kind:
    """A pattern, its place in the order of kinds, and whether its spans are always kept."""

    name: str
    rank: int
    pattern: str
    base: bool


KINDS = (
    Kind("assign", 0, ASSIGN, True),
    Kind("access", 1, ACCESS, True),
    Kind("hex", 2, HEX, True),
    Kind("live", 3, VENDOR, False),
    Kind("live", 3, TOKEN, False),
)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(kind: Kind) -> Column:
    """All matches of a pattern in ``_text`` with their places in code points.

    Splitting a text by a pattern gives what lies between the matches; a match starts after all
    earlier pieces and matches. Both run over the whole text.
    """
    pattern = _quoted(kind.pattern)
    return F.expr(
        f"""aggregate(
            zip_with(
                regexp_extract_all(_text, {pattern}, 0), split(_text, {pattern}, -1),
                (m, gap) -> struct(m, char_length(gap) as gap)
            ),
            struct(0 as at, cast(array() as array<struct<kind:string,rank:int,start:int,end:int,found:string>>) as spans),
            (a, x) -> if(x.m is null, a, struct(
                a.at + x.gap + char_length(x.m) as at,
                concat(a.spans, array(struct(
                    '{kind.name}' as kind, {kind.rank} as rank,
                    a.at + x.gap as start, a.at + x.gap + char_length(x.m) as end, x.m as found
                ))) as spans
            )),
            a -> a.spans
        )"""
    )


def candidates(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """A row per match: document, owner, repository, kind, span, and hash of the secret's value.

    A text in which a pattern cannot occur is not searched for it.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    found = [F.when(F.col("_text").rlike(k.pattern), _spans(k)) for k in KINDS]
    empty = F.expr("cast(array() as array<struct<kind:string,rank:int,start:int,end:int,found:string>>)")
    rows = rows.withColumn("_all", F.concat(*[F.coalesce(f, empty) for f in found]))
    out = rows.where(F.size("_all") > 0).select("doc_id", "owner", "repository", F.inline("_all"))
    value = F.when(
        F.col("kind") == "assign", F.regexp_replace("found", "^" + ASSIGN_HEAD, "")
    ).otherwise(F.col("found"))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    keep = (
        F.when(F.col("kind") == "assign", F.length(value) >= ASSIGN_LEAST)
        .when(F.col("kind") == "live", mixed)
        .otherwise(F.lit(True))
    )
    return out.where(keep).select(
        "doc_id", "owner", "repository", "kind", "rank", "start", "end", F.sha2(value, 256).alias("value_hash")
    ).distinct()


def ownership(found: DataFrame) -> DataFrame:
    """How widely each value is held, and the verdict: ``copied`` or ``live``.

    The first aggregate keeps one row per value, owner and repository, so a value that a third of
    the corpus holds is reduced before its key is gathered.
    """
    return (
        found.groupBy("value_hash", "owner", "repository")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value_hash", "owner")
        .agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
        .groupBy("value_hash")
        .agg(
            F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"),
            F.sum("n").alias("occurrences"),
        )
        .withColumn(
            "verdict",
            F.when(
                (F.col("owners") >= COPIED_OWNERS) | (F.col("repositories") >= COPIED_REPOSITORIES), "copied"
            ).otherwise("live"),
        )
    )


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    owner: Column | None = None, repository: Column | None = None,
) -> DataFrame:
    """A row per span with its verdict: ``doc_id, kind, rank, start, end, value_hash, owners,
    repositories, occurrences, verdict``.

    By default the owner is ``source`` and the repository ``source`` with ``lang``. Null texts have
    no spans; rows with a null id are searched and counted too. Places are code points, ends are
    exclusive. Base spans are all there; of the weaker kinds only values that look live, and none
    that lies inside a base span. Repeated rows give their spans once.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.col("source"), F.col("lang")) if repository is None else repository
    found = candidates(docs, id_col, text_col, owner, repository)
    judged = found.join(ownership(found), "value_hash").drop("owner", "repository").distinct()
    spans = judged.where("rank < 3 or verdict = 'live'")
    return spans


def secrets_by_document(docs: DataFrame, **columns) -> DataFrame:
    """The spans of ``scan_secrets`` gathered per document; documents without any are left out."""
    listed = F.expr(
        "array_sort(collect_set(struct(start, rank, kind, end, verdict)))"
    )
    return (
        scan_secrets(docs, **columns)
        .groupBy("doc_id")
        .agg(listed.alias("all"))
        .withColumn("base", F.expr("filter(all, x -> x.rank < 3)"))
        .withColumn(
            "all",
            F.expr(
                "filter(all, x -> x.rank < 3 or not exists(base, b -> b.start <= x.start and x.end <= b.end))"
            ),
        )
    )


def joined(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.expr(
        f"coalesce(array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ','), '')"
    )
