"""Whitening, quality classifier, alignment: whole tables and small cases."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from compare import database
from conftest import SF_DIR
from tallyframe.llm import alignment, classifier, queries, whitening

VECTORS = "vec_id long, embedding array<float>"
TEXTS = "doc_id long, text string"


# ---- whitening ----


def same_whitening(rows, ids, vectors, most=32):
    """Rows of ``by_component`` against plain formulas; signs are free."""
    n, deviation, there, explained = brute.whitened(vectors, most)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(rows) == len(ids) * there.shape[1] and list(got) != []
    for at, i in enumerate(ids):
        here = [got[i][k + 1] for k in range(there.shape[1])]
        assert all(r["n"] == n and r["deviation"] == deviation[at] for r in here)
        assert np.allclose([r["explained"] for r in here], explained, rtol=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in here)
    ours = np.array([[got[i][k + 1]["whitened"] for k in range(there.shape[1])] for i in ids])
    sign = np.sign((ours * there).sum(axis=0))
    assert np.allclose(ours, there * sign, atol=1e-7)


def test_whitening_of_the_whole_table(spark):
    rows = database(SF_DIR).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    found = queries.QUERIES["op11_embedding_whitening"](spark, SF_DIR).collect()
    same_whitening(found, [i for i, _ in rows], [v for _, v in rows])


def test_whitening_of_few_dimensions_and_far_means(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(60, 3)) * [1, 5, 0.2] + [3000, -70_000, 0.1]).astype(np.float32).tolist()
    frame = spark.createDataFrame(list(enumerate(vectors)), VECTORS).repartition(7)
    frame = frame.withColumn("key", F.lit("mine")).withColumn("vector", F.lit(1)).withColumn("n", F.lit(2))
    found = whitening.by_component(*whitening.whiten(frame, components=2))
    same_whitening(found.collect(), range(60), vectors, 2)


def test_which_vectors_are_whitened(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [0.0, 4.0], [1.0, 2.0]]
    bad = [None, [], [1.0, None], [math.nan, 1.0], [math.inf, 1.0], [1.0, -math.inf], [1e30, 1.0], [1.0], [1.0, 2.0, 3.0]]
    rows = [(1, good[0]), (1, good[1]), (None, good[2]), (None, good[3])] + [(9, v) for v in bad]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    whitened, model = whitening.whiten(frame)
    found = whitened.collect()
    assert model.n == 4 and sorted(map(str, (r["vec_id"] for r in found))) == ["1", "1", "None", "None"]
    _, deviation, there, _ = brute.whitened(good, 2)
    assert sorted(r["deviation"] for r in found) == sorted(deviation)
    ours = np.array([r["whitened"] for r in found])
    assert np.allclose(np.sort(np.abs(ours), axis=0), np.sort(np.abs(there), axis=0))


def test_whitening_without_variance_or_rows(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        frame = spark.createDataFrame(rows, VECTORS)
        assert whitening.by_component(*whitening.whiten(frame)).count() == 0
    one = spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], VECTORS)
    found = whitening.by_component(*whitening.whiten(one)).collect()
    assert [(r["vec_id"], r["component"]) for r in found] == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert all(r["whitened"] is None and r["explained"] == 0.0 and r["deviation"] == 0 for r in found)
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 7.0]) for k in range(9)], VECTORS)
    found = whitening.by_component(*whitening.whiten(line)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in found)
    assert {r["identity_error"] < 1e-9 for r in found} == {True}


def test_whitening_is_exact_beyond_64_bits(spark):
    vectors = [[2.0**44, 1.0], [-(2.0**44), 0.0], [2.0**43, 0.0]]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    whitened, model = whitening.whiten(frame)
    n, _, there, explained = brute.whitened(vectors, 2)
    assert model.sums == [sum(math.floor(64 * v[j]) + 1_000_000 for v in vectors) for j in range(2)]
    assert np.allclose(model.explained, explained) and {r["deviation"] for r in whitened.collect()} == {None}
    ours = np.array([r["whitened"] for r in whitened.orderBy("vec_id").collect()])[:, 0]
    assert np.allclose(np.abs(ours), np.abs(there[:, 0]))


# ---- classifier ----


def test_words_fall_into_places_by_their_text_alone():
    rng = random.Random(3)
    texts = ["", "one", " two  two\tone\n", "x" * 200_000, "é 😀 é"]
    texts += ["".join(rng.choice("ab \n\x0b") for _ in range(rng.randint(0, 300))) for _ in range(50)]
    texts.append(" ".join(rng.choices(["a", "bb", "ccc"], k=90_000)))
    import pyarrow as pa

    column = pa.array([None, *texts])[1:]
    words = {i: [] for i in range(len(texts))}
    for found, _, text in classifier._stretches(column):
        for place, i in zip(found.tolist(), text.tolist(), strict=True):
            words[i].append(place)
    known = {}
    for i, text in enumerate(texts):
        data, cut = text.encode(), classifier.PIECE_BYTES
        parts = [w for k in range(0, len(data), cut) for w in data[k : k + cut].split()]
        assert len(parts) == len(words[i])
        for part, place in zip(parts, words[i], strict=True):
            assert known.setdefault(part, place) == place
    assert len(set(known.values())) > 0.9 * len(known)


def test_context_sums_are_those_of_the_whole_corpus(spark):
    texts = ["a b c a", "b a", None, "", "c " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), TEXTS).repartition(3)
    got = classifier.context_sums(docs)
    where, signs = classifier.random_vectors()
    vector = np.zeros((len(where), classifier.WIDTH))
    for k in range(classifier.ENTRIES):
        vector[np.arange(len(where)), where[:, k]] = signs[:, k]
    import pyarrow as pa

    wanted = np.zeros_like(got)
    for text in texts:
        places = [p for found, *_ in classifier._stretches(pa.array([text], pa.string())) for p in found]
        for i, p in enumerate(places):
            wanted[p, -1] += 1
            for j in range(max(0, i - classifier.REACH), min(len(places), i + classifier.REACH + 1)):
                if i != j:
                    wanted[p, :-1] += vector[places[j]].astype(int)
    assert (got == wanted).all()


def test_quality_of_held_out_documents(spark):
    """The fold that nothing was learnt from, on a table with labels enough."""
    folder = SF_DIR.replace("sf0.001", "sf0.1")
    labels = {
        i: q for i, q in database(folder).execute("SELECT doc_id, quality FROM labels").fetchall()
    }
    found = queries.QUERIES["op12_quality_classifier"](spark, folder).collect()
    assert len(found) == 10_000 and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    asked = [(r, labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == q for r, q in asked) / len(asked)
    good = [r["predicted"] for r, q in asked if q == 1]
    poor = [1 - r["predicted"] for r, q in asked if q == 0]
    assert right > 0.96 and sum(good) / len(good) > 0.98 and sum(poor) / len(poor) > 0.8
    loss = -sum(math.log(max(r["score"] if q else 1 - r["score"], 1e-9)) for r, q in asked) / len(asked)
    assert loss < 0.12


def test_scores_do_not_see_labels_of_the_held_out_fold_or_other_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    changed = labels.withColumn("quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")).withColumn("score", F.lit(1))
    one = classifier.classify(docs, labels).collect()
    two = classifier.classify(other, changed.repartition(3)).collect()
    assert {(r["doc_id"], r["score"]) for r in one} == {(r["doc_id"], r["score"]) for r in two}


def test_classifier_of_odd_tables(spark):
    shape = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], shape)
    rows = [(1, None), (2, ""), (None, "a b"), (None, None), (4, "a b"), (4, "a b"), (4, "c"), (5, "x" * 300_000)]
    docs = spark.createDataFrame(rows, TEXTS)
    found = classifier.classify(docs, none).collect()
    assert len(found) == len(rows) and {r["score"] for r in found} == {0.5}
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)
    alike = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (5, 1, 0), (2, 1, 0), (None, 0, 0), (4, None, 0)], shape)
    assert {round(r["score"], 6) for r in classifier.classify(docs, alike).collect()} == {0.99}
    both = alike.union(spark.createDataFrame([(4, 0, 0), (4, 1, 1), (2, 7, 0)], shape))
    found = classifier.classify(docs, both).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    same = {r["score"] for r in found if r["doc_id"] in (1, 2)}
    assert len(same) == 1
    assert classifier.classify(spark.createDataFrame([], TEXTS), both).count() == 0


def test_temperature_undoes_a_scale():
    rng = np.random.default_rng(0)
    z = rng.normal(size=20_000) * 2
    y = (rng.random(20_000) < 1 / (1 + np.exp(-z))).astype(float)
    assert classifier.temperature(4 * z, y) == pytest.approx(4, rel=0.1)
    assert classifier.temperature(np.zeros(0), np.zeros(0)) == 1.0


# ---- alignment ----

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def paths():
    return queries.BYTE_LEVEL_MODEL, queries.PIECE_MODEL


def test_alignment_of_the_whole_table(spark):
    rows = database(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall()
    found = queries.QUERIES["op13_cross_tokenizer_alignment"](spark, SF_DIR).collect()
    got = {r["doc_id"]: tuple(r[m] for m in MEASURES) for r in found}
    assert len(found) == len(rows)
    assert got == dict(zip([i for i, _ in rows], brute.aligned([t for _, t in rows], *paths()), strict=True))


def test_alignment_of_odd_texts(spark, monkeypatch):
    texts = [
        None, "", " ", "a", "  two  blanks ", "\n\n x", "a\r\nb\t\tc", "\u2581x", "a \u2581", "x\0y", "é😀" * 5,
        "<|endoftext|> <s> </s> <unk> <0x41>", "A\u0301 \u200b\ufeff", "don't 'll 123,456", "日本語のテキスト。",
        "w " * 40_000, "n" * 3_000,
    ]
    rng = random.Random(8)
    texts += ["".join(rng.choices("ab .,1\n\té日😀'", k=rng.randint(0, 60))) for _ in range(150)]
    texts += texts[3:12]
    wanted = brute.aligned(texts, *paths())
    rows = [(None if k % 7 == 0 else k % 50, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, TEXTS).withColumn("key", F.lit(1)).withColumn("n_a", F.lit("x"))
    found = alignment.align(docs.repartition(4), *paths())
    got = sorted(((r["doc_id"], *[r[m] for m in MEASURES]) for r in found.documents.collect()), key=str)
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, wanted, strict=True)), key=str)
    total = found.pairs.agg(F.sum("n")).first()[0]
    assert total == sum(w[3] for w in wanted)


def test_chunks_do_not_change_an_alignment(monkeypatch):
    with open(paths()[0], "rb") as a, open(paths()[1], "rb") as b:
        a_file, b_file = a.read(), b.read()
    pairs = alignment.possible_pairs(alignment.ByteLevel(a_file).bytes, alignment.Pieces(b_file).bytes)
    aligner = alignment.Aligner(a_file, b_file, pairs)
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choices("abc  \n.'1é", k=400))
        monkeypatch.setattr(alignment, "CHUNK", 10**9)
        whole = aligner.measures(text)
        monkeypatch.setattr(alignment, "CHUNK", 7)
        assert len(list(aligner.chunks(text))) > 5
        parts = aligner.measures(text)
        assert whole[:4] == parts[:4]
        assert (whole[4] == parts[4]).all() and (whole[5] == parts[5]).all()


def test_both_libraries_give_the_same_byte_level_ids():
    with open(paths()[0], "rb") as file:
        fast, slow = alignment.ByteLevel(file.read()), None
        file.seek(0)
        slow = alignment.ByteLevel(file.read())
    assert fast._ranks is not None
    slow._ranks = None
    for text in (" a <|endoftext|> b", " \u0085\u001c x\u00a0y", " 𝟘١x", "\n  \n", " l'été c'est"):
        assert fast.encode(text) == list(slow.encode(text))


def test_links_are_among_the_possible_pairs():
    pairs = alignment.possible_pairs([b"ab", b"b", b""], [b"b", b"cab", b"x", b"b"])
    assert pairs.tolist() == [0, 1, 3, 4, 5, 7]


def test_empty_documents(spark):
    empty = alignment.align(spark.createDataFrame([], TEXTS), *paths())
    assert empty.documents.count() == 0 and empty.pairs.count() == 0
