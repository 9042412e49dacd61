"""The operators applied to the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (
    alignment,
    chosen_path,
    classifier,
    exact_dedup,
    fm_index,
    line_dedup,
    oracles,
    packing,
    pieces,
    pii,
    quality,
    substrings,
    warc,
    whitening,
)
from tallyframe.llm.common import table

#: Where the public tokenizers lie; a parameter of the operator.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL_MODEL = "/opt/tokenizers/byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"), with_text=False)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base", "places", "_text")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.encode(docs, PIECE_MODEL, with_ids=False).drop("ids")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fm_index.dedup(docs, with_text=False).drop("intervals")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).drop("url")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.drop("text", "score")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened, model = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitening.by_component(whitened, model)


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, BYTE_LEVEL_MODEL, PIECE_MODEL).documents


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_pii,
        op3_exact_dedup,
        op4_line_dedup,
        op5_sentencepiece,
        op6_substring_dedup,
        op7_warc,
        op8_quality_rules,
        op9_ngram_jaccard_join,
        op10_best_fit_packing,
        op11_embedding_whitening,
        op12_quality_classifier,
        op13_cross_tokenizer_alignment,
    )
}

ORACLES = {
    "op3_exact_dedup": oracles.COPIES,
    "op4_line_dedup": oracles.LINES,
    "op7_warc": oracles.RECORDS,
    "op8_quality_rules": oracles.QUALITY,
}
