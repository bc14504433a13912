"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Patterns propose spans in each text. The hash of every proposed value is then counted
over the whole corpus by distinct repositories and owners: a value that many owners
carry is a copied example, one that stays with few owners and does not read like a
placeholder is live-looking. The base kinds are always reported; the wider kinds only
where the counts say owner-specific and the value looks live.

Null or empty texts have no spans. A null owner counts as one owner, a null repository
as one repository. Repeated rows each keep their own result. Offsets are code points,
ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import let, row_key, stored, unused


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds a span; ``group`` is the secret inside it, of ``least`` characters.

    ``needs`` are patterns of which the secret must match every one.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False
    needs: tuple[str, ...] = ()


KINDS = (
    Kind(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
        base=True,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Kind("hex", r"[0-9a-f]{24,}", base=True),
    Kind("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("prefixed", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    Kind("opaque", r"[A-Za-z0-9+/_-]{32,}={0,2}", needs=("[0-9]", "[A-Z]", "[a-z]")),
)
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|1234567|abcdef"


def _spans_of(text: Column, rank: int, kind: Kind) -> Column:
    """Spans of one kind: the pieces between matches give the code point offsets."""
    pattern = F.lit(kind.pattern)

    def wanted(span: Column) -> Column:
        good = F.length(span["value"]) >= kind.least
        for need in kind.needs:
            good = good & span["value"].rlike(need)
        return good

    def located(found: Column) -> Column:
        value = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else found
        rows = F.arrays_zip(
            F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found)).alias("before"),
            found.alias("match"),
            value.alias("value"),
        )
        start = F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,value:string>>").alias("out")
        )
        walked = F.aggregate(
            rows,
            start,
            lambda acc, r: F.struct(
                (acc["at"] + F.length(r["before"]) + F.length(r["match"])).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(r["before"])).alias("start"),
                            (acc["at"] + F.length(r["before"]) + F.length(r["match"])).alias("stop"),
                            r["value"].alias("value"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda acc: acc["out"],
        )
        return F.transform(
            F.filter(walked, wanted),
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(rank).alias("rank"),
                s["stop"].alias("stop"),
                F.lit(kind.name).alias("kind"),
                F.lit(kind.base).alias("base"),
                F.sha2(s["value"], 256).alias("h"),
                (
                    ~s["value"].rlike(PLACEHOLDER)
                    & (F.size(F.array_distinct(F.split(s["value"], ""))) >= 8)
                ).alias("looks_live"),
            ),
        )

    empty = F.array().cast(
        "array<struct<start:int,rank:int,stop:int,kind:string,base:boolean,h:string,looks_live:boolean>>"
    )
    return F.when(
        text.rlike(kind.pattern),
        let(F.regexp_extract_all(text, pattern, F.lit(0)), located),
    ).otherwise(empty)


def proposals(text: Column) -> Column:
    """All proposed spans of a text, by start and then by kind as listed."""
    return F.sort_array(F.concat(*[_spans_of(text, i, k) for i, k in enumerate(KINDS)]))


def anything(text: Column) -> Column:
    """True if any pattern matches."""
    out = F.lit(False)
    for kind in KINDS:
        out = out | text.rlike(kind.pattern)
    return out


def ownership(found: DataFrame) -> DataFrame:
    """(h, n_repos, n_owners) over rows (h, repo, owner).

    Three grouped counts, each with map-side partial results, so a value in a third of
    all rows is still one partial row per task and group.
    """
    return (
        found.groupBy("h", "owner", "repo")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("h", "owner")
        .agg(F.count(F.lit(1)).alias("n_repos"))
        .groupBy("h")
        .agg(F.sum("n_repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    )


def scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    shared_owners: int = 3,
) -> DataFrame:
    """One row per document: (doc_id, key, spans), spans sorted by start and kind.

    Each span is (start, rank, stop, kind, base, class, n_repos, n_owners). ``class`` is
    ``copied`` for values of ``shared_owners`` owners or more, else ``live`` if the value
    looks live, else ``placeholder``. Spans of the wider kinds are kept only if ``live``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    owner = F.coalesce(F.col(owner_col).cast("string"), F.lit(""))
    repo = F.coalesce(F.col(repo_col).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            row_key(F.col(id_col), text).alias("key"),
            owner.alias("owner"),
            repo.alias("repo"),
            proposals(text).alias("found"),
        ),
        "secrets",
    )
    each = rows.where(F.size("found") > 0).select(
        "key", "owner", "repo", F.explode("found").alias("f"), F.col("f.h").alias("h")
    )
    counts = stored(ownership(each.select("h", "owner", "repo")), "owners")
    kind = (
        F.when(F.col("n_owners") >= shared_owners, F.lit("copied"))
        .when(F.col("f.looks_live"), F.lit("live"))
        .otherwise(F.lit("placeholder"))
    )
    judged = (
        each.join(counts, "h")
        .withColumn("class", kind)
        .where(F.col("f.base") | (F.col("class") == "live"))
        .groupBy("key")
        .agg(
            F.sort_array(
                F.collect_set(
                    F.struct(
                        "f.start", "f.rank", "f.stop", "f.kind", "f.base", "class", "n_repos", "n_owners"
                    )
                )
            ).alias("spans")
        )
    )
    kind_type = judged.schema["spans"].dataType
    return (
        rows.select("doc_id", "key")
        .join(judged, "key", "left")
        .select("doc_id", "key", F.coalesce("spans", F.array().cast(kind_type)).alias("spans"))
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])),
    )


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """The text with every maximal run of spans replaced by ``mark``."""
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")
    )
    walked = F.aggregate(
        spans,
        start,
        lambda acc, s: F.when(s["stop"] <= acc["at"], acc).otherwise(
            F.struct(
                s["stop"].alias("at"),
                F.when(
                    (s["start"] >= acc["at"]) | (F.size(acc["out"]) == 0),
                    F.concat(
                        acc["out"],
                        F.array(
                            F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                            F.lit(mark),
                        ),
                    ),
                )
                .otherwise(acc["out"])
                .alias("out"),
            )
        ),
    )
    return let(
        walked,
        lambda w: F.concat(
            F.array_join(w["out"], ""), F.substring(text, w["at"] + 1, F.lit(2**31 - 1))
        ),
    )


def redact(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    mark: str = "[SECRET]",
    **options,
) -> DataFrame:
    """The documents with their reported secrets replaced; all rows and columns stay.

    Only texts in which some pattern matches take part in the join.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = scan(docs, id_col=id_col, text_col=text_col, **options).where(F.size("spans") > 0)
    held, found = unused(docs, "row_key"), unused(docs, "row_spans")
    spans = spans.select(F.col("key").alias(held), F.col("spans").alias(found)).dropDuplicates([held])
    touched = anything(text)
    clean = docs.where(~touched)
    joined = (
        docs.where(touched)
        .withColumn(held, row_key(F.col(id_col), text))
        .join(spans, held, "left")
        .withColumn(
            text_col,
            F.when(F.col(found).isNull(), F.col(text_col)).otherwise(
                redacted(text, F.col(found), mark)
            ),
        )
        .select(docs.columns)
    )
    return clean.unionByName(joined)
