"""Every registered query over whole tables: against SQL, or against its plain version."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from compare import database, difference
from conftest import SF_DIR
from tallyframe.llm import packing, pieces, pii, queries


@pytest.fixture(scope="module")
def tables():
    return database(SF_DIR)


@pytest.fixture(scope="module")
def rows(tables):
    return tables.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def collected(spark, name, *columns):
    frame = queries.QUERIES[name](spark, SF_DIR)
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def by_id(rows, values):
    return {i: value for (i, _), value in zip(rows, values, strict=True)}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_against_sql(spark, tables, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), tables, queries.ORACLES[name]) is None


def test_repeated_byte_strings(spark, rows):
    got = collected(spark, "op1_suffix_array_dedup", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == by_id(rows, brute.byte_strings([t for _, t in rows], 400))


def test_private_data(spark, rows):
    got = collected(spark, "op2_pii", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    for i, text in rows:
        spans = brute.private(text)
        counts = tuple(sum(k == kind for k, *_ in spans) for kind in brute.KINDS)
        written = ",".join(":".join(map(str, x)) for x in spans)
        assert got[i] == (*counts, brute.sha(written))


def test_sentencepiece_gives_the_ids_of_the_library(spark, rows):
    import numpy as np
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    got = collected(spark, "op5_sentencepiece", "n_tokens", "ids_sha256", "round_trip")
    for i, text in rows:
        ids = np.array(library.encode(text or ""), np.int32)
        assert got[i] == (len(ids), brute.sha(ids.tobytes()), True)


def test_repeated_windows(spark, rows):
    got = collected(spark, "op6_substring_dedup", "n_words", "n_removed", "kept_sha256")
    assert got == by_id(rows, brute.word_windows([t for _, t in rows], 13))


def test_near_duplicates(spark, rows):
    got = collected(
        spark, "op9_ngram_jaccard_join", "class_id", "copy_of", "n_copies", "n_links"
    )
    assert got == brute.near(rows)


def test_packing(spark, rows):
    placed = queries.QUERIES["op10_best_fit_packing"](spark, SF_DIR).toPandas()
    lengths = []
    for i, text in rows:
        n = len(brute.words(text))
        own = placed[placed["doc_id"] == i].sort_values("piece")
        assert own["length"].sum() == n and own["start"].tolist() == list(range(0, n, 4096))
        lengths += own["length"].tolist()
    bins = placed.groupby("bin_id").agg({"length": "sum", "bin_capacity": "first"})
    wanted = brute.best_fit(sorted(lengths, reverse=True), packing.CAPACITIES, packing.BIN_COST)
    assert sorted(zip(bins["length"], bins["bin_capacity"], strict=True)) == wanted


def test_pipeline(spark, tables, rows):
    good = {
        i for (i,) in tables.execute(
            "SELECT doc_id FROM labels WHERE quality = 1 AND coalesce(toxic, 0) = 0"
        ).fetchall()
    }
    now = brute.kept_by_quality(rows, good)
    now = [(i, x[2]) for i, x in brute.line_dedup(now).items()]
    classes = brute.near(now)
    now = [(i, t) for i, t in now if classes[i][0] == i]
    now = [(i, brute.redacted(t)) for i, t in now]
    found = corpus_pipeline.run(spark, SF_DIR).toPandas()
    lengths = {i: len(brute.words(t)) for i, t in now if brute.words(t)}
    assert found.groupby("doc_id")["length"].sum().to_dict() == lengths
    cut = [n for i in lengths for n in found[found["doc_id"] == i]["length"]]
    bins = found.groupby("bin_id").agg({"length": "sum", "bin_capacity": "first"})
    wanted = brute.best_fit(sorted(cut, reverse=True), packing.CAPACITIES, packing.BIN_COST)
    assert sorted(zip(bins["length"], bins["bin_capacity"], strict=True)) == wanted


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns
        assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]


def test_contexts_lead_to_unseen_identifiers(spark):
    rng = random.Random(2)
    texts = [f"write to mailbox: u{k}@example.org today" for k in range(30)]
    texts += [f"write to mailbox: member{k}-{10_000 + k} today" for k in range(4)]
    texts += [f"the total of {rng.randint(100000, 999999)} items" for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert all(found[k]["n_email"] == 1 and found[k]["n_context"] == 0 for k in range(30))
    assert all(found[k]["spans"] == f"context:18:{18 + len(f'member{k - 30}-{10000 + k}')}" or
               found[k]["n_context"] == 1 for k in range(30, 34))
    assert all(found[k]["spans"] == "" for k in range(34, 64))


def test_contexts_of_glued_labels(spark):
    texts = [f"write mail:u{k}@example.org today" for k in range(30)]
    # The label stays, in front and behind; a neighbouring word is looked for over its whole length.
    far, long = "nine" * 30, " " * 100
    texts += ["write mail:member-10007 today", "write <b>mail:member-10008</b> today"]
    texts += [f"{far}{long}u{k}@example.com" for k in range(5)] + [f"{far} member-10009"]
    # Few of these words stand beside personal data, though most that stand alone do.
    texts += [f"call tel=u{k}@example.net now" for k in range(4)] + ["tel 555123"]
    texts += [f"tel:{w}" for w in "abcdefghijklmnop"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs, min_score=0.6).collect()}
    assert found[30] == "context:11:23" and found[31] == "context:14:26"
    assert found[37] == "context:121:133"
    assert all(found[k] == "" for k in range(42, len(texts)))


def test_packed_texts_are_put_together_in_order(spark):
    texts = ["a b c", "d e", "f", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    placed = packing.pack_documents(docs, [2, 6])
    got = packing.sequences(docs, placed).collect()
    assert [(r["bin_capacity"], r["text"]) for r in got] == [(6, "a b c d e f")]


def test_archives_have_one_member_a_record(spark, tmp_path):
    from tallyframe.llm import warc

    pages = spark.createDataFrame(
        [(1, "http://a", "x" * 2000), (2, "http://b\nc", "x" * 2000), (3, None, None), (3, "d", "é")],
        "page_id long, url string, html string",
    )
    index = warc.normalise(spark, warc.write_archives(pages)).collect()
    for row in index:
        with open(row["archive"].removeprefix("file:"), "rb") as file:
            file.seek(row["offset"])
            record = gzip.decompress(file.read(row["length"]))
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert record.count(b"WARC-Record-ID") == 1
    back = warc.read_records(spark.createDataFrame(index)).collect()
    assert sorted((r["_id"], bytes(r["payload"]), r["record_type"], r["_refers"]) for r in back) == [
        (1, b"", "revisit", 2),
        (2, b"x" * 2000, "response", None),
        (3, b"", "response", None),
        (3, "é".encode(), "response", None),
    ]


def test_decoding(spark):
    texts = ["Hello  world", "", None, "naïve 😀\n\tx"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = pieces.decode(pieces.encode(docs, queries.PIECE_MODEL), queries.PIECE_MODEL)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {
        i: t or "" for i, t in enumerate(texts)
    }
