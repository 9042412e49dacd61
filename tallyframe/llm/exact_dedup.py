"""Exact dedup by composable polynomial fingerprints.

A normalised text is cut into chunks. Each chunk is hashed by itself as a
polynomial of its bytes modulo two primes, and the hash is shifted by the number
of bytes that follow the chunk in its text; the fingerprint of a text is then
the sum of its chunks' shifted hashes, so chunks of a huge text can be hashed
anywhere and in any order. Texts longer than one chunk are dealt out by chunk.

Texts of equal fingerprint and length are compared chunk by chunk: over all of a
group, the least and the greatest bytes of each chunk must be the same. That is
an aggregate combined before the shuffle, so a group of any size is compared
without meeting in one task. A group that fails is split by its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import ascii_lower, id_back, id_of, whole_text, write_out

CHUNK_BYTES = 32_768
#: Two primes below 2**31, so that products fit into 64 bits.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003_331, 1_234_567_891)
FINGERPRINT = ["n", "f0", "f1"]

_POWERS: dict[int, np.ndarray] = {}


def powers(prime: int, base: int, count: int) -> np.ndarray:
    """base**0 ... base**(count-1) modulo prime; grown by doubling and kept."""
    have = _POWERS.get(prime, np.ones(1, np.uint64))
    while len(have) < count:
        step = np.uint64(pow(base, len(have), prime))
        have = np.concatenate([have, have * step % np.uint64(prime)])
    _POWERS[prime] = have
    return have


def chunk_hash(data: bytes, follow: int, prime: int, base: int) -> int:
    """The hash of a chunk, shifted by the ``follow`` bytes that come after it."""
    digits = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    terms = digits * powers(prime, base, len(data))[: len(data)][::-1]
    # Terms are below 2**39: sums of 2**24 of them fit.
    here = int(sum(int(terms[i : i + 2**24].sum()) for i in range(0, len(terms), 2**24)))
    return here % prime * pow(base, follow, prime) % prime


def _hash_with(primes: tuple[int, int]):
    def hash_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for k, (prime, base) in enumerate(zip(primes, BASES, strict=True)):
                rows[f"f{k}"] = [
                    chunk_hash(data, follow, prime, base)
                    for data, follow in zip(rows["data"], rows["follow"], strict=True)
                ]
            yield rows[["_row", "_id", "_sha", "n", "f0", "f1"]]

    return hash_chunks


def _chunked(texts: DataFrame, chunk_bytes: int) -> DataFrame:
    n = F.col("n")
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(chunk_bytes))
    cut = texts.select("*", F.posexplode(starts).alias("at", "start"))
    data = F.substring("data", F.col("start") + 1, F.lit(chunk_bytes))
    return cut.withColumn("data", data).withColumn("n", n.cast("long"))


def _texts(docs: DataFrame) -> DataFrame:
    """(_id, data, n): normalised UTF-8 bytes."""
    data = F.encode(ascii_lower(whole_text()), "UTF-8")
    return docs.select(id_of().alias("_id"), data.alias("data")).withColumn("n", F.length("data"))


def fingerprints(
    docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, primes: tuple[int, int] = PRIMES
) -> DataFrame:
    """(_id, _sha, n, f0, f1): one row for each row of ``docs``."""
    shape = "_row long, _id long, _sha string, n long, f0 long, f1 long"
    texts = _texts(docs).withColumn("_sha", F.sha2("data", 256))
    # The number of a row keeps rows apart that share id and text, until their chunks are added up.
    texts = texts.withColumn("_row", F.monotonically_increasing_id())
    follow = F.greatest(F.col("n") - F.col("start") - chunk_bytes, F.lit(0))

    def hashed(chunks: DataFrame) -> DataFrame:
        columns = ["_row", "_id", "_sha", "n", "data", follow.alias("follow")]
        return chunks.select(*columns).mapInPandas(_hash_with(primes), shape)

    small = hashed(_chunked(texts.filter(F.col("n") <= chunk_bytes), chunk_bytes))
    large = _chunked(texts.filter(F.col("n") > chunk_bytes), chunk_bytes)
    summed = (
        hashed(large.repartition("_row", "at"))
        .groupBy("_row", "_id", "_sha", "n")
        .agg(F.sum("f0").alias("f0"), F.sum("f1").alias("f1"))
    )
    parts = [(F.col(f"f{k}") % prime).alias(f"f{k}") for k, prime in enumerate(primes)]
    own = ["_id", "_sha", "n"]
    return small.select(*own, "f0", "f1").union(summed.select(*own, *parts))


def _unequal(docs: DataFrame, members: DataFrame, chunk_bytes: int) -> DataFrame:
    """Of groups with equal fingerprints, those whose texts differ in some chunk."""
    texts = _texts(docs).withColumn("_sha", F.sha2("data", 256)).join(members, ["_id", "_sha"])
    compared = _chunked(texts, chunk_bytes).groupBy(*FINGERPRINT, "at").agg(
        F.min("data").alias("least"), F.max("data").alias("most")
    )
    return compared.filter("least <> most").select(*FINGERPRINT).distinct()


def dedup(
    docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, primes: tuple[int, int] = PRIMES
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row a row of ``docs``.

    Texts are equal when they are identical after lower-casing A-Z; null counts
    as empty. The largest id of a group stays, and every row counts in
    ``group_size``. Rows without an id give way to those with one; where all of a
    group have none, ``keep_id`` is null and they are kept. Rows that share the
    largest id and the text are all kept: they are one document.
    """
    found = write_out(fingerprints(docs.select("doc_id", "text"), chunk_bytes, primes), "texts")
    several = found.groupBy(*FINGERPRINT).count().filter("count > 1").drop("count")
    members = found.join(several, FINGERPRINT).select("_id", "_sha", "f0", "f1").distinct()
    unequal = write_out(_unequal(docs, members, chunk_bytes), "unequal").withColumn("_bad", F.lit(1))
    # Where a comparison failed, the texts' own digests tell them apart.
    part = F.when(F.col("_bad") == 1, F.col("_sha")).otherwise("")
    marked = found.join(unequal, FINGERPRINT, "left").withColumn("_part", part).drop("_bad")
    key = [*FINGERPRINT, "_part"]
    own = id_back(F.col("_id"))
    sizes = marked.groupBy(*key).agg(F.max(own).alias("keep"), F.count("*").alias("group_size"))
    return marked.join(sizes, key).select(
        own.alias("doc_id"),
        F.col("keep").alias("keep_id"),
        "group_size",
        F.coalesce(own == F.col("keep"), F.col("keep").isNull()).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
