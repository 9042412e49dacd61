"""Labelled examples and delimited text derived from the ``lineitem`` table.

Every fixture covers the whole table and keeps the row keys, so that the work
of a check grows with the data.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.storage import new_shared_path

KEYS = ["l_orderkey", "l_linenumber"]
HEADER = "quantity;price;discount;tax;label"
CELLS = [(flag, status) for flag in "ANR" for status in "FO"]
SPLIT_HEADER = ";".join([f"ten_{flag}{status}" for flag, status in CELLS] + ["label"])
CELLS_HEADER = ";".join([f"cell_{flag}{status}" for flag, status in CELLS] + ["label"])


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _examples(items: DataFrame, label: Column, features: list[Column]) -> DataFrame:
    vector = array_to_vector(F.array(*[f.cast("double") for f in features]))
    return items.select(*KEYS, label.cast("double").alias("label"), vector.alias("features"))


def _pair() -> Column:
    # Quantities 1 .. 50 in pairs, with 25 and 26 in different ones. A tree with
    # 32 bins can only be sure to split where it wants if there are at most 32
    # values; with all 50, the thresholds depend on a sample of the rows.
    return F.floor(F.col("l_quantity") / 2).cast("double")


def _graded_columns() -> tuple[Column, list[Column]]:
    quantity, discount, tax = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    upper = F.when(discount > 0.055, 8.0).otherwise(6.0)
    lower = F.when(tax > 0.035, 5.0).otherwise(3.0)
    features = [_pair(), F.col("l_extendedprice") / 1000, discount * 100, tax * 100]
    return F.when(quantity > 25, upper).otherwise(lower), features


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four classes (3, 5, 6, 8) that are a rule of quantity, discount and tax."""
    return _examples(lineitem(spark, sf_dir), *_graded_columns())


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, features = _graded_columns()
    number = F.when(label == 3, 0.0).when(label == 5, 1.0).when(label == 6, 2.0).otherwise(3.0)
    return _examples(lineitem(spark, sf_dir), number, [F.col("l_quantity"), *features[1:]])


def halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two classes, separable by a plane through the origin."""
    label = F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0)
    return _examples(lineitem(spark, sf_dir), label, [_pair(), 25 - _pair()])


def _in_cell(flag: str, status: str) -> Column:
    return (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)


def _cell_columns() -> tuple[Column, list[Column]]:
    # Six indicator features. Three rows in five are labelled 3 + their cell,
    # the others 3 .. 8 by line number, so no model can be right everywhere.
    features = [F.when(_in_cell(*cell), 1.0).otherwise(0.0) for cell in CELLS]
    own = F.coalesce(*[F.when(_in_cell(*cell), 3.0 + i) for i, cell in enumerate(CELLS)])
    other = 3.0 + (F.col("l_linenumber") - 1) % 6
    return F.when(F.col("l_quantity") <= 30, own).otherwise(other), features


def _is_training() -> Column:
    return F.col("l_orderkey") % 10 < 8


def _split_columns() -> tuple[Column, list[Column]]:
    # In each cell a common label (3 or 8) is ahead of the cell's own. Naive Bayes
    # takes the tenfold indicators for ten pieces of evidence and answers the own
    # label, the others the commonest. Validation rows have the own label more often.
    own = F.coalesce(*[F.when(_in_cell(*cell), 3.0 + i) for i, cell in enumerate(CELLS)])
    features = [F.when(_in_cell(*cell), 10.0).otherwise(0.0) for cell in CELLS]
    quantity, most = F.col("l_quantity"), F.when(_is_training(), 10).otherwise(25)
    label = (
        F.when(quantity <= most, own)
        .when(quantity <= 40, F.when(own < 6, 3.0).otherwise(8.0))
        .otherwise(3.0 + (F.col("l_linenumber") - 1) % 6)
    )
    return label, features


def split_examples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training rows (eight orders in ten) and validation rows (the others)."""
    items = lineitem(spark, sf_dir)
    columns = _split_columns()
    return tuple(
        _examples(items.filter(part), *columns) for part in (_is_training(), ~_is_training())
    )


def split_lines(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The same two sets as text."""
    label, features = _split_columns()
    items, line = lineitem(spark, sf_dir), _line([*features, label]).alias("value")
    return tuple(
        _write_lines(spark, items.filter(part).select(line), SPLIT_HEADER, name)
        for name, part in (("training", _is_training()), ("validation", ~_is_training()))
    )


def imperfect_lines(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The two sets of ``split_lines`` with lines that are no examples in both, by line number."""
    label, features = _split_columns()
    line, number = _line([*features, label]), F.col("l_linenumber")
    value = (
        F.when(number == 5, F.concat(F.lit("x;"), line))
        .when(number == 6, F.regexp_replace(line, "^[^;]*;", ""))
        .when(number == 7, F.regexp_replace(line, "^[^;]*;", "ten;"))
        .otherwise(line)
    )
    items = lineitem(spark, sf_dir)
    return tuple(
        _write_lines(spark, items.filter(part).select(value.alias("value")), SPLIT_HEADER, name)
        for name, part in (("odd-training", _is_training()), ("odd-validation", ~_is_training()))
    )


def eleven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven whole features of few values and six classes, on which no two kinds of model agree.

    The label is mostly a rule that no plane and no tree of five levels can follow,
    with a sixth of the rows labelled otherwise.
    """
    order, part, supp, line = (
        F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    quantity = F.floor((F.col("l_quantity") - 1) / 10)
    discount, tax = F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    status = F.when(F.col("l_linestatus") == "F", 0).otherwise(1)
    month = F.month("l_shipdate") - 1
    features = [quantity, discount, tax, line - 1, flag, status, month, order % 4, part % 5, supp % 3]
    features.append((order + part) % 3)
    rule = (
        F.when((quantity >= 3) & (discount >= 5), 3 + F.col("l_partkey") % 5 % 2)
        .when(quantity >= 3, F.when(tax >= 4, 5).otherwise(6))
        .when(month % 3 == flag, 7)
        .otherwise(F.when(discount + tax >= 9, 8).otherwise(5))
    )
    label = F.when((order + 2 * part + 3 * supp + line) % 6 == 0, 3 + (order + line) % 6).otherwise(rule)
    return _examples(lineitem(spark, sf_dir), label, features)


def header_only(spark: SparkSession) -> str:
    """A source that has a header and no rows."""
    return _write_lines(spark, spark.createDataFrame([], "value string"), SPLIT_HEADER, "empty")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six noisy classes; the best answer is the commonest label of each cell."""
    return _examples(lineitem(spark, sf_dir), *_cell_columns())


def _write_lines(spark: SparkSession, lines: DataFrame, header: str, name: str) -> str:
    # The header is a partition of its own, hence the first file by name.
    path = new_shared_path(spark, name)
    first = spark.range(1, numPartitions=1).select(F.lit(header).alias("value"))
    first.union(lines).write.text(path)
    return path


def _line(columns: list[Column]) -> Column:
    return F.concat_ws(";", *[c.cast("string") for c in columns])


def raw_lines(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two sources with the same header, some odd lines in each.

    Line number 7 ends in two empty fields, and returned items of line number 1
    carry the header text inside the line.
    """
    plain = _line(
        [F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
        + [F.col("l_linenumber").cast("double")]
    )
    value = (
        F.when(F.col("l_linenumber") == 7, F.concat(plain, F.lit(";;")))
        .when(
            (F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R"),
            F.concat(F.lit(f"{HEADER};"), plain),
        )
        .otherwise(plain)
    )
    items = lineitem(spark, sf_dir)
    finished = F.col("l_linestatus").eqNullSafe("F")
    return [
        _write_lines(
            spark,
            items.filter(part).select(value.alias("value")),
            HEADER,
            name,
        )
        for name, part in (("lines-F", finished), ("lines-other", ~finished))
    ]


def odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two features and a label, some of them broken, by line number."""
    number, line = F.col("l_quantity").cast("string"), F.col("l_linenumber")
    label = line.cast("double").cast("string")
    value = F.concat_ws(";", F.lit("0.5"), number, label)
    for broken, parts in {
        1: [F.lit("x"), number],
        2: [F.lit("nan"), number],
        3: [F.lit("NaN"), number],
        4: [number],
        5: [F.lit("0.0"), F.lit("0.0"), number],
        6: [F.lit("-Infinity"), number],
    }.items():
        value = F.when(line == broken, F.concat_ws(";", *parts, label)).otherwise(value)
    return lineitem(spark, sf_dir).select(value.alias("value"))


def cell_lines(spark: SparkSession, sf_dir: str) -> str:
    """The ``cells`` examples as text: six features and the label."""
    label, features = _cell_columns()
    lines = lineitem(spark, sf_dir).select(_line([*features, label]).alias("value"))
    return _write_lines(spark, lines, CELLS_HEADER, "cells")


def graded_lines(spark: SparkSession, sf_dir: str) -> str:
    """The ``graded`` examples as text."""
    label, features = _graded_columns()
    lines = lineitem(spark, sf_dir).select(_line([*features, label]).alias("value"))
    return _write_lines(spark, lines, HEADER, "graded")


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine votes per row from the integers of the table, with many ties."""
    order, part, supp, line = (
        F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    sources = [
        order % 10,
        part % 10,
        supp % 10,
        line % 10,
        (order + part) % 10,
        (order + supp) % 10,
        (part + supp) % 10,
        order % 3,
        part % 3,
    ]
    return lineitem(spark, sf_dir).select(
        *KEYS, *[s.cast("double").alias(f"vote_{i}") for i, s in enumerate(sources)]
    )


def vote_columns() -> list[str]:
    return [f"vote_{i}" for i in range(9)]

