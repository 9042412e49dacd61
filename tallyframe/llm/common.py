"""What the operators share: columns of text, shared folders, table access."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.storage import new_shared_path

#: Blanks are U+0020 and U+0009 to U+000D; everything else belongs to words.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
#: Stands for a missing document id, after all others.
NO_ID = 2**63 - 1
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_of(column: str = "doc_id") -> Column:
    """The id, with null as the largest id."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_back(column: Column) -> Column:
    return F.when(column != NO_ID, column)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, ascii_uppercase, ascii_lowercase)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK_RUN), "")


def set_apart(
    docs: DataFrame, needed: Sequence[str], replaced: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with the caller's other columns under names that no step uses, and how to get all back.

    Columns in ``replaced`` are left out: the operator makes its own. The names of
    the rest come back with ``by_own_names``, in their order.
    """
    back, inner = {}, []
    for i, name in enumerate(docs.columns):
        if name in replaced and name not in needed:
            continue
        inside = name if name in needed else f"__caller_{i}"
        inner.append(F.col(f"`{name}`").alias(inside))
        if name not in replaced:
            back[name] = F.col(inside)
    return docs.select(*inner), back


def by_own_names(back: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in back.items()]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand texts to Python a thousand at a time, so that workers stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_out(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again; cuts its lineage."""
    path = new_shared_path(frame.sparkSession, name)
    with small_batches(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps whose results are written.

    They are kept until the driver collects the frames they belong to, which on a
    driver with little to do may take longer than the whole job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def among(keys: DataFrame, column: str, bits: int = 22) -> Column:
    """A condition on ``column`` that holds for all values in ``keys``, and few others.

    A bitmap of 2**bits hashed values, the same size for any input. It spares a
    shuffle rows that a join would drop; with very many keys it lets all pass.
    """
    at = F.pmod(F.xxhash64(column), F.lit(2**bits))
    word, bit = F.shiftright(at, 6), (at % 64).cast("int")
    # A left shift by a column has no function of its own name for columns.
    own = keys.select(word.alias("w"), F.expr("1L").alias("one"), bit.alias("b"))
    own = own.selectExpr("w", "shiftleft(one, b) AS v").groupBy("w").agg(F.bit_or("v").alias("v"))
    words = keys.sparkSession.range(2 ** (bits - 6)).withColumnRenamed("id", "w")
    row = words.join(own, "w", "left").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("w", F.coalesce("v", F.lit(0)).alias("v")))),
            lambda x: x["v"],
        ).alias("bitmap")
    )
    return F.get(row.scalar(), word.cast("int")).bitwiseAND(_power(bit)) != 0


def _power(bit: Column) -> Column:
    return F.get(F.array(*[F.lit(2**k if k < 63 else -(2**63)) for k in range(64)]), bit)
