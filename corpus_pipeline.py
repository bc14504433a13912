"""From raw documents to token ids: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, decontaminate, minhash, quality, secret_scan
from riskloom.llm.common import fold, read, stored, unused
from riskloom.llm.queries import vocabulary

MARK = "[SECRET]"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3; the same rows teach as in the query."""
    model = quality.train(docs, read(spark, sf_dir, "labels"), usable=fold(F.col("doc_id"), 5) != 0)
    score = unused(docs, "quality_score")
    return quality.scored(docs, model, name=score).where(F.col(score) >= 0.3).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 similarity of 5-word shingles."""
    return minhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark words."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced and ``n_chars`` of changed texts renewed."""
    hidden = secret_scan.redact(docs, mark=MARK)
    if "n_chars" not in docs.columns:
        return hidden
    changed = F.col("text").contains(MARK)
    kind = docs.schema["n_chars"].dataType
    return hidden.withColumn(
        "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of their decoded text."""
    return bpe.encode(docs, vocabulary()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(bpe.decoded(F.col("ids"), vocabulary()), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", hide_secrets),
    ("BPE encoding and decoding", encode),
]

# the conditional random field of the first stage has no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
