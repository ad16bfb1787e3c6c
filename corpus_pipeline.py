"""A training-data pipeline: quality, language, lines, near copies, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one
before it kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import language_id, line_dedup, packing, quality, simhash
from salesflow.llm._shared import release, shared_table
from salesflow.llm.queries import QUALITY, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose calibrated quality score is below the limit."""
    release()
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_documents(docs, model, threshold=QUALITY).where("predicted = 1").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: no text, no letters.  That holds
    also if no document has a label, so that nothing is learned."""
    release()
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = language_id.predict_languages(docs, model)
    return found.where(F.col("lang_pred") != language_id.UND).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; ``n_chars`` is counted anew."""
    release()
    out = line_dedup.drop_recurring_lines(docs, short_docs=line_dedup.MIN_DOCS)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy group stays: the smallest id.  Rows equal
    in id and text are one document; rows without an id cannot be told apart
    and stay if one of them does."""
    release()
    groups = simhash.simhash_groups(docs)
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stay")).distinct()
    # the ids that stay grow with the documents: a merge join at every size
    stay = shared_table(stay, "stay").hint("merge")
    return (docs.join(stay, F.col("doc_id").eqNullSafe(F.col("_stay")))
            .select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary())


STAGES = [("quality classifier", quality_stage), ("language ID", language_stage), ("line dedup", line_stage),
          ("SimHash near-dedup", simhash_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs


#: The stages hold trained models and iterated links: no SQL expresses them.
ORACLE_SQL = None
