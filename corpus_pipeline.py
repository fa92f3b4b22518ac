"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's ``docs``.  All but the last keep
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runway.llm.best_fit import pack
from runway.llm.line_dedup import without_repeats
from runway.llm.mixing import mixed_documents
from runway.llm.ngram_join import one_of_each
from runway.llm.quality_rules import keep_good
from runway.llm.queries import vocabulary_path
from runway.llm.store import scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; failing lines of the others too."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller document holds already go."""
    return without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the smallest id."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may come twice."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences of 2048 ids."""
    return pack(docs, vocabulary_path())


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mix_sources", mix), ("best_fit_packing", packing)]

#: Tokenizing is not SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table.  What a stage wrote on its
    way is freed when its result is there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
