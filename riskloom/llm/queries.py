"""Registered corpus queries: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    alignment,
    bpe,
    decontaminate,
    embedding_dedup,
    langid,
    minhash,
    pii,
    prefix_trie,
    quality,
    secret_scan,
    suffix_dedup,
    token_files,
    toxicity,
)
from riskloom.llm.common import fold, read
from riskloom.llm.oracles import ORACLES  # noqa: F401
from riskloom.plans.lineage import scratch_path

QUERIES = {}



def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and owner-specific secrets of every document."""
    rows = secret_scan.scan(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"),
        secret_scan.span_list(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["class"] == "live")).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["class"] == "copied")).cast("long").alias("n_copied"),
    )


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark's 13-word windows."""
    rows = decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def vocabulary() -> str:
    """Where the public vocabulary lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    rows = bpe.encode(read(spark, sf_dir, "documents"), vocabulary())
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("ids"), vocabulary()), 256).alias("decoded_sha256"),
    )


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over 3-word shingles at 0.85 similarity."""
    rows = minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    index = toxicity.train(docs, read(spark, sf_dir, "labels"), usable=~held_out)
    score = F.col("toxicity.score")
    return toxicity.scored(docs, index).select(
        "doc_id",
        held_out.alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        F.array_join(F.slice("toxicity.evidence", 1, 5).cast("array<string>"), ",").alias("evidence"),
    )


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its lines."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality.train(docs, read(spark, sf_dir, "labels"), usable=~held_out)
    return quality.scored(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, family first."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = langid.train(docs, usable=~held_out)
    return langid.predicted(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score"
    )


@query
def op9_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings at cosine 0.9."""
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and further personal data of every document."""
    rows = pii.scan(read(spark, sf_dir, "documents"))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[n(kind) for kind in pii.BASE],
        F.sha2(pii.span_list(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.span_list(F.col("spans")).alias("spans"),
    )


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its 400-byte repeats."""
    rows = suffix_dedup.without_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + (s["stop"] - s["start"])
    )
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the regenerated conversations."""
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(read(spark, sf_dir, "conversations"))))


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document, read back from its token files."""
    target = scratch_path(spark, "token-files")
    files = token_files.write(read(spark, sf_dir, "documents"), target, vocabulary())
    return token_files.documents(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between a byte-level and a piece vocabulary for every document."""
    import public_tokenizers

    rows = alignment.aligned(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
