"""From raw documents to packed training sequences, in five stages.

    toxicity             documents that the toxicity model rejects go
    line_dedup           lines spread over many sites stay at their first place only
    ngram_jaccard_join   one document of each group of near and exact copies stays
    decontamination      documents that share a window with a benchmark item go
    best_fit_packing     the rest is packed into sequences

Each stage reads what the stage before it wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import stored
from siltstone.llm.decontaminate import decontaminated
from siltstone.llm.line_dedup import line_dedup
from siltstone.llm.ngram_join import one_of_each_group
from siltstone.llm.packing import best_fit_packing
from siltstone.llm.toxicity import fit, training_rows, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labelled documents outside the held-out quarter; scores of 0.3 and more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return without_toxic(docs, fit(training_rows(docs, labels)), threshold=0.3)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut boilerplate lines; a document that consisted of nothing else is gone with them."""
    cut = line_dedup(docs)
    text = F.coalesce("text", F.lit(""))
    emptied = (F.col("removed_lines") > 0) & (F.btrim(text, F.lit(" \t\r\n")) == "")
    changed = F.when(F.col("removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.where(~emptied).withColumn("n_chars", changed).select(*docs.columns)


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", ngram_stage),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

# SQL can express neither the toxicity model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that come through."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
