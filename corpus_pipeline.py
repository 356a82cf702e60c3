"""The corpus pipeline: five stages over ``documents``, each on all that the one before has kept.

1. Toxic documents go.
2. Of documents linked by near copies, the one with the smallest id stays.
3. Passages of 100 bytes or more that occur earlier in the corpus are cut out.
4. Secrets are replaced by a mark.
5. What is left is put into length buckets and batches.

All stages but the last return the columns of ``documents``; where a text changes, ``n_chars``
follows it.

Defined cases: a null text stays null and is empty to every stage; documents with an empty set of
shingles are near copies of nothing; repeated rows of an id are one document and stay or go
together, and rows without id all stay, as nothing tells which of them is which; without labels
nothing is toxic; ties go to the smaller id; an empty table passes every stage and gives no rows;
further columns are passed on up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthlens.llm import jaccard, packing, repeats, secret_scan, toxicity
from monthlens.llm.shared import ship_package, stored, table


def _recounted(changed: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    kind = changed.schema["n_chars"].dataType
    return changed.withColumn(
        "n_chars", F.length(F.coalesce("text", F.lit(""))).cast(kind)
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from the labelled rows of the table."""
    ship_package(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard.drop_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return _recounted(repeats.remove_repeats(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(secret_scan.redact(docs, secret_scan.scan(docs)))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.n_words())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack_documents),
]

#: None of the first three stages can be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
