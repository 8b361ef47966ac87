"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again
as the next one's input.

Toxic documents go; repeated lines go (and documents that lose all their words); one document of each
group of near copies stays; personal data and the terms that reveal it are replaced; what is left is
packed into sequences. All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storyloom.llm import line_dedup, ngram_join, packing, pii, toxicity
from storyloom.operators.materialize import materialize
from storyloom.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.keep_first_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_per_group(docs, width=5, num=80, den=100)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("n-gram join", drop_near_copies),
          ("pii", remove_personal_data), ("packing", pack)]

#: The first stage scores by a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
