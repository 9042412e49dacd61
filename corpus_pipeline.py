"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. ``docs`` needs doc_id and
text; all other columns, of any name, are handed on by all stages but the last,
and n_chars, where there is one, gets the new length of a changed text. Null
texts count as empty and are rejected by the first stage, as having no words.
Rows without an id, or with repeated ones, are judged each by its own text. An
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.settled import settled
from tallyframe.llm import chosen_path, line_dedup, packing, pii, quality
from tallyframe.llm.common import by_own_names, set_apart, table, write_out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the target-against-corpus test reject go."""
    apart, back = set_apart(docs, ["doc_id", "text"])
    judged = quality.judge(apart, table(spark, sf_dir, "labels"))
    stays = judged.withColumn("kept", settled(F.col("kept"))).filter("kept")
    return stays.select(*by_own_names(back))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, except from the document with the smallest id."""
    apart, back = set_apart(docs, ["doc_id", "text", "n_chars"])
    kept, cut = line_dedup.dedup_lines(apart), F.col("n_dropped") > 0
    kept = kept.withColumn("text", F.when(cut, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in back:
        size = F.when(cut, F.length("kept_text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return kept.select(*by_own_names(back))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return chosen_path.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by a mark."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: The last stage packs by a sequential rule that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_out(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
