"""Quality rules: repetition and length rules, then a target-against-corpus test.

The test is a hashed n-gram log-likelihood ratio. The n-grams are all single words
of a text and all pairs of neighbouring words, hashed whole. Two multinomials over
their buckets, one of trusted documents and one of the whole corpus, give each
bucket a weight ``log p(bucket | trusted) - log p(bucket | corpus)``, where the
trusted one is smoothed with the corpus. A document's score is the mean weight of
its n-grams, and it is kept at ``threshold`` or above.

Everything runs as DataFrame expressions. The corpus is counted whole; the
trusted model is fitted on at most ``most_trusted`` labelled documents, spread
over the ids. The weights are one row of ``BUCKETS`` numbers whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import WORD, by_own_names, set_apart, whole_text, words_of

#: A power of two, so that a bucket is the last bits of a hash.
BUCKETS = 262_144
WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
#: Mean weight below which a document is rejected.
THRESHOLD = -0.35
MOST_TRUSTED = 10_000
#: So many n-grams a bucket, dealt as in the corpus, are added to those of trusted documents:
#: what they lack is no evidence while they are few, and equal shares weigh 0 at any size.
SMOOTHING = 1.0


def _codes(words: Column) -> Column:
    """The bucket of each single word."""
    last_bits = F.lit(BUCKETS - 1)
    return F.transform(words, lambda word: F.crc32(word).bitwiseAND(last_bits).cast("int"))


def _pair(x: Column, y: Column) -> Column:
    """The bucket of a word and its right neighbour, from theirs."""
    return (31 * x + y).bitwiseAND(F.lit(BUCKETS - 1))


def _from(values: Column, skipped: int) -> Column:
    return F.slice(values, skipped + 1, F.greatest(F.size(values) - skipped, F.lit(0)))


def _all_words() -> Column:
    return words_of(whole_text())


def trusted_ids(labels: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """At most ``most`` ids of good, harmless documents, spread over all ids."""
    spread = (F.pmod(F.col("doc_id"), F.lit(1_000_003)) * 7_919) % 1_000_003
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
    return good.select("doc_id").distinct().orderBy(spread, "doc_id").limit(most)


def weights(docs: DataFrame, labels: DataFrame, most_trusted: int = MOST_TRUSTED) -> DataFrame:
    """One row: the weight of every bucket; zeros if no document is trusted."""
    spark = docs.sparkSession
    # The ids number most_trusted at most, so they may be broadcast at any size of the corpus.
    trusted = trusted_ids(labels, most_trusted).withColumn("_good", F.lit(1))
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted), "doc_id", "left")
    # A row a word with its neighbour, then one for each of the two buckets: both are generated
    # code, where making one list of all buckets of a text is not.
    codes = marked.select("_good", _codes(_all_words()).alias("_codes"))
    code = F.col("_codes")
    next_to = F.arrays_zip(code.alias("x"), _from(code, 1).alias("y"))
    beside = codes.select("_good", F.inline(next_to).alias("x", "y"))
    both = F.stack(F.lit(2), F.col("x"), _pair(F.col("x"), F.col("y"))).alias("bucket")
    # The last word has no neighbour.
    grams = beside.select("_good", both).filter("bucket IS NOT NULL")
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_good").alias("good"))
    buckets = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    counted = buckets.join(counts, "bucket", "left").fillna(0)
    whole = counted.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "good", "raw"))).alias("all"),
        F.sum("good").alias("n_good"),
        F.sum("raw").alias("n_raw"),
    )

    prior = SMOOTHING * BUCKETS

    def ratio(x: Column) -> Column:
        as_frequent = x["good"] * F.col("n_raw") / x["raw"]
        return F.when(x["raw"] > 0, F.log((as_frequent + prior) / (F.col("n_good") + prior)))

    ratios = F.transform("all", lambda x: F.coalesce(ratio(x), F.lit(0.0)))
    none = F.array_repeat(F.lit(0.0), BUCKETS)
    return whole.select(F.when(F.col("n_good") > 0, ratios).otherwise(none).alias("weights"))


def _join(x: Column, y: Column) -> Column:
    return F.xxhash64(x, y)


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures; one narrow pass, linear in the length of a text."""
    n = F.col("n_words")
    docs = docs.withColumn("_words", _all_words())
    here = docs.select(
        *[c for c in docs.columns if c != "_words"],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _codes(F.col("_words")).alias("_codes"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    lines = F.filter(F.split(whole_text(), "\n"), lambda line: line.rlike(WORD))
    # Five words are two pairs and a word; what is padded at the end is cut off.
    two = F.zip_with("_hashes", _from(F.col("_hashes"), 1), _join)
    here = here.withColumn("_twos", two)
    four = F.zip_with("_twos", _from(F.col("_twos"), 2), _join)
    here = here.withColumn("_fours", F.slice(four, 1, F.greatest(n - 3, F.lit(0)).cast("int")))
    # Only a text in which four words come twice can have a window twice.
    near = F.size(F.array_distinct("_fours")) < F.size("_fours")
    windows = F.zip_with("_fours", _from(F.col("_hashes"), WINDOW - 1), _join)
    windows = F.slice(windows, 1, (n - WINDOW + 1).cast("int"))
    none = F.array().cast("array<bigint>")
    here = (
        here.withColumn("n_symbols", F.regexp_count(whole_text(), F.lit(SYMBOLS)).cast("long"))
        .withColumn("_lines", lines)
        .withColumn(
            "n_dup_lines",
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        )
        .withColumn("_windows", F.when((n >= WINDOW) & near, windows).otherwise(none))
    )
    # Only texts in which a window comes twice are sorted: equal windows are then neighbours.
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    here = here.withColumn("_sorted", F.when(twice, F.sort_array(placed)).otherwise(empty))
    order = F.col("_sorted")
    repeated = F.filter(
        order,
        lambda x, j: (
            F.coalesce(F.get(order, j + 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(order, j - 1)["h"] == x["h"], F.lit(False))
        ),
    )
    starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
        lambda a, i: F.struct(
            i.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), i - a["last"])).alias("sum")
        ),
        lambda a: a["sum"].cast("long"),
    )
    return here.withColumn("n_repeat_words", covered)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    most_trusted: int = MOST_TRUSTED,
) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``score`` and ``kept``.

    A null text has no words and fails; a score of no words is null. Rows with
    a null or repeated id are judged each by its own text. Without trusted
    documents only the base rules decide. Columns of these names are replaced.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own += ["base_failed", "score", "kept"]
    docs, back = set_apart(docs, ["doc_id", "text"], own)
    model = weights(docs.select("doc_id", "text"), labels, most_trusted).scalar()
    n = F.col("n_words")
    here = measures(docs).select("*", model.alias("_model"))
    code, weight = F.col("_codes"), F.col("_model")
    # Nothing else in this step: so the optimizer puts the weights themselves into the sum,
    # and they are not copied into every row. The last word has no neighbour.
    each = F.zip_with(
        code,
        _from(code, 1),
        lambda x, y: F.get(weight, x) + F.coalesce(F.get(weight, _pair(x, y)), F.lit(0.0)),
    )
    total = F.aggregate(each, F.lit(0.0), lambda sum, value: sum + value)
    here = here.select(*docs.columns, *own[:5], total.alias("_total"))
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    return (
        here.withColumn("base_failed", failed)
        .withColumn("score", F.when(n > 0, F.col("_total") / (2 * n - 1)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .select(*by_own_names(back), *own)
    )
