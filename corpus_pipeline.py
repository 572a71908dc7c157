"""The corpus pipeline: five stages from raw documents to a training mix.

Every stage takes the documents its predecessor kept and returns a DataFrame, which is written
as Parquet and read again as the next one's input. All but the last return the columns of the
documents.

1. quality: rows that the n-gram classifier rejects go.
2. near duplicates: of each class of near-copies, one row stays.
3. decontamination: rows that contain a passage of a benchmark item go, unless it is an item of a
   few words, which says nothing.
4. secrets: secrets in texts are replaced by a mark.
5. mixing: every row is repeated as often as the mix of sources takes it.

Null texts are empty documents: the classifier judges them, and as copies of each other one of
them stays. Repeated rows are copies. Rows without an id are treated like others; among near
copies the smallest id stays, null last. Empty tables pass through. Columns beyond those of the
documents are kept, whatever their names. The last stage's number of a copy is called `copy`, or
`copy_2` and so on where a column has that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, kneser_ney, mixing, secrets, simhash
from tidemark.llm.common import read_table, row_keys, unpacked
from tidemark.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, trained on the labelled documents among them, keeps."""
    return kneser_ney.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: that with the smallest id, then row hash."""
    keyed = row_keys(docs, "doc_id", "text")
    rows = keyed.select(F.col("key").alias("doc_id"), "text", F.col("doc_id").alias("id"))
    classes = simhash.near_duplicates(rows.select("doc_id", "text")) \
        .select(F.col("doc_id").alias("key"), F.col("component_id").alias("class")).distinct()
    named = materialise(
        rows.select(F.col("doc_id").alias("key"), "id").distinct().join(classes, "key"),
        "row_classes")
    kept = named.groupBy("class").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first")).select(
        F.col("first.key").alias("key"))
    # Rows that are equal in every column have one hash: of these too, one stays.
    single = keyed.select("row", "key", "key_rest").dropDuplicates(["key", "key_rest"])
    return unpacked(single.join(kept, "key", "left_semi"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no passage with a benchmark item."""
    keyed = row_keys(docs, "text")
    found = decontaminate.contaminated(
        keyed.select(F.col("key").alias("doc_id"), "text"),
        read_table(spark, sf_dir, "benchmark"))
    return unpacked(keyed.select("row", "key").join(
        found.filter("condemned").select(F.col("doc_id").alias("key")), "key", "left_anti"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the secrets in their texts replaced."""
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as its source's rate asks for, with `copy` counting from 0."""
    return mixing.mixed(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_redaction),
    ("mixing", source_mix),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer's test; the stages are
#: tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
