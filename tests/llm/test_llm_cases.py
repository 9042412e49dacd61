"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import base64
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_DIR
from tallyframe.llm import (
    chosen_path,
    exact_dedup,
    fm_index,
    line_dedup,
    packing,
    pieces,
    pii,
    quality,
    queries,
    substrings,
    warc,
)

SHAPE = "doc_id long, text string"
OPERATORS = {
    "substrings": substrings.dedup,
    "pii": pii.find,
    "redact": pii.redact,
    "exact": exact_dedup.dedup,
    "lines": line_dedup.dedup_lines,
    "pieces": lambda docs: pieces.encode(docs, queries.PIECE_MODEL),
    "windows": fm_index.dedup,
    "quality": lambda docs: quality.judge(docs, docs.sparkSession.read.parquet(f"{SF_DIR}/labels.parquet")),
    "near": chosen_path.join,
    "one_of_each": chosen_path.one_of_each,
    "packing": packing.pack_documents,
}


NAMES = ["n", "kept", "g", "rows", "sha", "score", "_found", "bin_id", "n_lines"]
#: Names that steps of some operator use inside.
INNER_NAMES = (
    "_id _k _dropped _lines _words _model _sorted _windows _text _new places _gaps _steps _blocks "
    "_offsets _places _all _digits _row _part _bad key copies value word rep root top sketch __caller_0"
).split()


def documents(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows_and_clashing_columns(spark, name):
    long = "word " * 30_000 + "x" * 100_000
    rows = [(1, None), (2, ""), (None, "a b"), (None, None), (3, long), (4, "a b"), (4, "a b"), (4, "c")]
    docs = documents(spark, rows)
    clashing = [*NAMES, *INNER_NAMES]
    docs = docs.select("*", *[F.lit("mine").alias(c) for c in clashing])
    made = OPERATORS[name](docs)
    found = made.collect()
    if name in ("redact", "one_of_each"):
        assert made.columns == docs.columns
    for c in set(clashing) & set(made.columns) if name in ("redact", "one_of_each", "lines", "quality") else ():
        own = name == "quality" and c in ("kept", "score") or name == "lines" and c == "n_lines"
        assert own or {r[c] for r in found} == {"mine"}
    if name == "packing":
        # 130,001 words... cut into pieces; texts without words have no row.
        assert {r["doc_id"] for r in found} == {None, 3, 4}
        assert sum(r["length"] for r in found if r["doc_id"] == 3) == 30_001
    elif name == "one_of_each":
        # Texts without words are copies of each other, and so are the equal ones.
        assert {r["doc_id"] for r in found} == {1, 3, 4}
    elif name == "exact":
        # Both rows of the largest id stay, and of rows without an id those that no other id has.
        got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found), key=str)
        wanted = [(1, 2, 3, False), (2, 2, 3, True), (None, 4, 3, False), (None, 2, 3, False)]
        wanted += [(3, 3, 1, True), (4, 4, 3, True), (4, 4, 3, True), (4, 4, 1, True)]
        assert got == sorted(wanted, key=str)
    else:
        assert Counter(r["_id" if name == "base" else "doc_id"] for r in found) == Counter(i for i, _ in rows)
    if name == "lines":
        assert Counter(r["kept_text"] for r in found) == Counter(t or "" for _, t in rows)
    if name == "redact":
        assert Counter(r["text"] for r in found) == Counter(t for _, t in rows)
    if name in ("substrings", "windows"):
        gone = {"substrings": {3: len(long.encode())}, "windows": {}}[name]
        assert all(r["n_removed"] in (0, gone.get(r["doc_id"], 0)) or r["doc_id"] == 3 for r in found)
    if name == "pieces":
        assert all(r["round_trip"] for r in found)
    if name == "quality":
        assert not any(r["kept"] for r in found)


def test_empty_pages(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def _mixed_texts(seed, words, count):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab cdé ") for _ in range(rng.randint(10, 60))) for _ in range(20)]
    texts = [None, "", "a" * 100, "ab" * 60, " ".join("abcab" * 9)]
    for _ in range(count):
        parts = rng.choices(pool, k=rng.randint(0, 4)) + [
            "".join(rng.choice(words) for _ in range(rng.randint(1, 50))) for _ in range(3)
        ]
        rng.shuffle(parts)
        texts.append("".join(parts))
    return texts


def test_byte_strings_of_another_width(spark):
    texts = _mixed_texts(1, "abcd", 80)
    docs = documents(spark, list(enumerate(texts))).repartition(5)
    found = substrings.dedup(docs, width=40, gram=8, run=5).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert got == dict(enumerate(brute.byte_strings(texts, 40)))


@pytest.mark.parametrize("crowded", [2, 10_000])
def test_windows_of_another_width(spark, crowded):
    texts = _mixed_texts(2, "abcd ", 80)
    docs = documents(spark, list(enumerate(texts))).repartition(5)
    found = fm_index.dedup(docs, width=5, gram=2, crowded=crowded, shard_words=400).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found}
    assert got == dict(enumerate(brute.word_windows(texts, 5)))


def test_colliding_fingerprints_are_told_apart(spark):
    rows = [(i, t) for i, t in enumerate(["ab", "AB", "ba", "cd", "dc", "abc" * 50, "ABC" * 50, "cba" * 50])]
    docs = documents(spark, rows)
    found = exact_dedup.dedup(docs, chunk_bytes=16, primes=(3, 2)).collect()
    keep = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found}
    assert keep == {
        0: (1, 2), 1: (1, 2), 2: (2, 1), 3: (3, 1), 4: (4, 1), 5: (6, 2), 6: (6, 2), 7: (7, 1)
    }


def test_chunks_combine_to_the_hash_of_the_whole():
    data, (prime, base) = bytes(range(256)) * 9, (exact_dedup.PRIMES[0], exact_dedup.BASES[0])
    whole = exact_dedup.chunk_hash(data, 0, prime, base)
    parts = [data[i : i + 100] for i in range(0, len(data), 100)]
    ends = [min(i + 100, len(data)) for i in range(0, len(data), 100)]
    shifted = [exact_dedup.chunk_hash(p, len(data) - e, prime, base) for p, e in zip(parts, ends)]
    assert sum(shifted) % prime == whole


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (7, 3)])
def test_line_runs_do_not_depend_on_the_batches(spark, batches, fanout):
    rng = random.Random(4)
    pool = [f"  A line of number {k} \t" for k in range(30)] + ["short", "", "é" * 9, "é" * 10]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 8)))) for i in range(60)]
    docs = documents(spark, rows).repartition(4)
    found = line_dedup.dedup_lines(docs, batches=batches, fanout=fanout).collect()
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found}
    assert got == brute.line_dedup(rows)


def test_lines_go_from_their_own_text_only(spark):
    a, b, c = "the first long line", "the second long line", "the third long line"
    own = [f"a line of its own, number {k}" for k in range(9)]
    rows = [
        (1, f"{a}\n{b}\n{c}"),
        # One document twice, and two texts of one id.
        (2, f"{own[0]}\n{a}\n{own[1]}\n{b}"),
        (2, f"{own[0]}\n{a}\n{own[1]}\n{b}"),
        (3, f"{a}\n{own[2]}"),
        (3, f"{own[3]}\n{own[4]}"),
        (None, f"{b}\n{own[5]}"),
        (None, f"{own[6]}\n{c}\nshort"),
        (None, f"{own[7]}\n{own[8]}"),
        (None, f"{b}\n{own[5]}"),
    ]
    found = line_dedup.dedup_lines(documents(spark, rows).repartition(3)).collect()
    wanted = [
        (1, 3, 0, rows[0][1]),
        (2, 4, 2, f"{own[0]}\n{own[1]}"),
        (2, 4, 2, f"{own[0]}\n{own[1]}"),
        (3, 2, 1, own[2]),
        (3, 2, 0, rows[4][1]),
        (None, 2, 1, own[5]),
        (None, 2, 1, own[5]),
        (None, 2, 0, rows[7][1]),
        (None, 3, 1, f"{own[6]}\nshort"),
    ]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_large_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK_ROWS", 16)
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(150 + i, " ".join(f"y{rng.randint(0, 10**6)}" for _ in range(30))) for i in range(100)]
    found = chosen_path.join(documents(spark, rows).repartition(6)).collect()
    got = {r["doc_id"]: (r["class_id"], r["copy_of"], r["n_copies"], r["n_links"]) for r in found}
    assert got == brute.near(rows)


def test_near_copies_among_rows_without_an_id(spark):
    rng = random.Random(7)

    def text(name):
        return [f"{name}{rng.randint(0, 10**6)}" for _ in range(80)]

    def near(words):
        return " ".join([*words[:-1], "other"])

    a, b, c = text("a"), text("b"), text("c")
    rows = [(1, " ".join(a)), (None, near(a)), (None, " ".join(b)), (None, near(b)), (None, " ".join(b))]
    rows += [(None, " ".join(text("d"))) for _ in range(20)]
    # An id with two texts, of which one is linked.
    rows += [(2, " ".join(text("e"))), (2, " ".join(c)), (3, near(c))]
    docs = documents(spark, rows).repartition(3)
    found = Counter(tuple(r) for r in chosen_path.join(docs).collect())
    assert found == {
        (1, 1, 1, 1, 1): 1,
        (None, 1, None, 1, 1): 1,
        (None, None, None, 2, 1): 2,
        (None, None, None, 1, 1): 1,
        (None, None, None, 1, 0): 20,
        (2, 2, 2, 1, 0): 1,
        (2, 2, 2, 1, 1): 1,
        (3, 2, 3, 1, 1): 1,
    }
    kept = [(r["doc_id"], r["text"]) for r in chosen_path.one_of_each(docs).collect()]
    one = [x for x in kept if x[1] in (" ".join(b), near(b))]
    assert len(one) == 1
    wanted = [rows[0], *rows[5:25], *rows[25:27]]
    assert sorted((x for x in kept if x not in one), key=str) == sorted(wanted, key=str)


def test_base_spans_of_odd_texts(spark):
    rng = random.Random(6)
    texts = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "x@y.z😀 +1 (743) 555-3824. 😀4994226020900891"]
    texts += ["9" * 3_000 + " " + "a" * 3_000 + "@", "a@b" + ".c" * 5_000, "1 " * 5_000]
    texts += ["".join(rng.choices("ab@.+- 0123456789()é😀_%\n", k=rng.randint(0, 60))) for _ in range(500)]
    found = pii.find_base(documents(spark, list(enumerate(texts)))).collect()
    for row in found:
        spans = brute.private(texts[row["_id"]])
        assert row["base"] == ",".join(":".join(map(str, x)) for x in spans)


def test_quality_without_trusted_documents_uses_the_base_rules(spark):
    docs = documents(spark, [(1, "one two " * 3), (2, " ".join(map(str, range(40))))])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()} == {1: False, 2: True}


def test_order_and_inside_of_words_count_for_quality(spark):
    rng = random.Random(12)
    after = {f"word{i}": [f"word{rng.randrange(300)}" for _ in range(12)] for i in range(300)}

    def sentence(n):
        w = [f"word{rng.randrange(300)}"]
        while len(w) < n:
            w.append(rng.choice(after[w[-1]]))
        return w

    good = [" ".join(sentence(80)) for _ in range(300)]
    backwards = [" ".join(reversed(sentence(80))) for _ in range(300)]
    encoded = [base64.b64encode(rng.randbytes(1_200)).decode() for _ in range(60)]
    encoded = ["\n".join(x[i : i + 76] for i in range(0, len(x), 76)) for x in encoded]
    # Edges of words are as before, only their inside is another.
    inside = [" ".join(w[:2] + f"{rng.randrange(10**9)}" + w[2:] for w in sentence(80)) for _ in range(60)]
    texts = good + backwards + encoded + inside
    labels = [(i, 1, 0) for i in range(200)]
    docs = documents(spark, list(enumerate(texts)))
    # Little text is little evidence either way; 0 parts what is likelier from trusted documents.
    trusted = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.judge(docs, trusted, threshold=0.0)
    rows = {r["doc_id"]: (r["base_failed"], r["kept"], r["score"]) for r in found.collect()}
    assert not any(failed for failed, *_ in rows.values())
    assert {i for i, (_, kept, _) in rows.items() if kept} == set(range(300))
    plain = brute.kept_by_quality(list(enumerate(texts)), set(range(200)), threshold=0.0)
    assert {i for i, _ in plain} == set(range(300))


def test_packing_does_not_depend_on_partitions(spark):
    docs = documents(spark, [(i, "w " * (i * 37 % 900)) for i in range(300)])
    one = packing.pack_documents(docs.coalesce(1), [256, 512], shard_pieces=50)
    many = packing.pack_documents(docs.repartition(9), [256, 512], shard_pieces=50)
    assert one.exceptAll(many).count() == 0 and one.count() == many.count()
    with pytest.raises(ValueError, match="positive"):
        packing.pack_documents(docs, [])


def test_every_row_of_equal_texts_comes_out(spark):
    from compare import database, difference
    from conftest import SF_DIR as folder
    from tallyframe.llm import oracles

    long = "Ab c" * 30_000
    rows = [(None, "a"), (None, "A"), (None, "a"), (1, "b"), (1, "b"), (2, long), (2, long.upper()), (None, long)]
    rows += [(7, "x" * 40_000), (None, "y" * 40_000), (None, "z" * 40_000), (3, None), (4, "")]
    found = exact_dedup.dedup(documents(spark, rows).repartition(4))
    by_row = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()), key=str)
    wanted = [(None, None, 3, True)] * 3 + [(1, 1, 2, True)] * 2 + [(2, 2, 3, True)] * 2
    wanted += [(None, 2, 3, False), (7, 7, 1, True), (None, None, 1, True), (None, None, 1, True)]
    wanted += [(3, 4, 2, False), (4, 4, 2, True)]
    assert by_row == sorted(wanted, key=str)
    tables = database(folder)
    tables.execute("CREATE OR REPLACE TABLE mine (doc_id BIGINT, text VARCHAR)")
    tables.executemany("INSERT INTO mine VALUES (?, ?)", rows)
    assert difference(found, tables, oracles.COPIES.replace("FROM documents", "FROM mine")) is None


def test_packed_texts_of_rows_that_share_an_id(spark):
    rows = [(1, "a b"), (1, "c d e"), (None, "x y"), (None, "p q r"), (None, "x y"), (2, "w " * 9)]
    docs = documents(spark, rows)
    placed = packing.pack_documents(docs, [4, 8])
    texts = [r["text"] for r in packing.sequences(docs, placed).collect()]
    assert sorted(" ".join(texts).split()) == sorted(w for _, t in rows for w in t.split())
    for _, text in rows[:5]:
        assert any(text in t for t in texts)
    assert sum(t.count("x y") for t in texts) == 2


@pytest.mark.parametrize("threshold", [0.5, 0.6])
def test_links_at_lower_thresholds(spark, threshold):
    """Pairs of texts of just enough shared shingles are found with the promised recall."""
    rng = random.Random(9)
    rows, pairs = [], 200
    for k in range(pairs):
        one = [f"a{rng.randint(0, 10**9)}" for _ in range(90)]
        cut = int(90 * 2 * threshold / (1 + threshold)) + 3
        other = one[:cut] + [f"b{rng.randint(0, 10**9)}" for _ in range(90 - cut)]
        rows += [(2 * k, " ".join(one)), (2 * k + 1, " ".join(other))]
    found = chosen_path.join(documents(spark, rows).repartition(4), threshold=threshold, recall=0.999)
    got = {r["doc_id"]: r["n_links"] for r in found.collect()}

    def alike(x, y):
        x, y = ({tuple(t.split()[i : i + 5]) for i in range(86)} for t in (x, y))
        return len(x & y) / len(x | y) >= threshold

    linked = [k for k in range(pairs) if alike(rows[2 * k][1], rows[2 * k + 1][1])]
    assert len(linked) > 0.9 * pairs
    assert sum(got[2 * k] for k in linked) >= 0.995 * len(linked)


def test_the_screen_loses_no_more_than_it_says():
    assert chosen_path.screen_for(1.0) == chosen_path.COORDINATES and chosen_path.screen_for(0.8) == 33
    assert chosen_path.screen_for(0.5) < chosen_path.screen_for(0.6) < 33


def test_stages_of_odd_documents(spark):
    import corpus_pipeline

    good = " ".join(f"word{k} of text" for k in range(20))
    rows = [(1, None), (2, ""), (None, good), (None, good + " more"), (3, good + " x" * 40_000), (4, good)]
    rows += [(5, "Some other line that is long\n" + good.replace("text", "prose")), (5, "short")]
    docs = documents(spark, rows)
    docs = docs.select("*", *[F.lit("mine").alias(c) for c in [*NAMES, *INNER_NAMES]])
    for kind in (docs, docs.withColumn("n_chars", F.length("text").cast("int")), docs.limit(0)):
        now = kind
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF_DIR)
            assert now.schema.names == kind.columns and now.dtypes == kind.dtypes, name
        kept = now.collect()
        assert all(r[c] == "mine" for r in kept for c in [*NAMES, *INNER_NAMES])
        assert not any(r["doc_id"] in (1, 2) for r in kept)
        packed = corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR)
        assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in kept if r["text"]}


def test_pages_with_ties_nulls_and_long_payloads(spark):
    long = "é" * 300_000
    rows = [(1, "u", long), (2, None, long), (2, "v", long), (None, "w", long), (None, None, None), (3, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.select("*", F.lit("mine").alias("payload"), F.lit(1).alias("record_type"))
    found = warc.archive(pages).collect()
    assert len(found) == len(rows)
    assert sorted(r["payload_bytes"] for r in found) == [0, 0] + [600_000] * 4
    assert {r["record_type"] for r in found if not r["payload_bytes"]} == {"response"}


def test_secrets_are_found_by_the_words_beside_them(spark):
    rng = random.Random(11)

    def secret():
        return "".join(rng.choices("0123456789abcdef", k=38)) + "a1"

    texts = [f'here token = "{secret()}" end' for _ in range(12)]
    # Shorter ones behind the same word, and long mixed words behind words of all kinds.
    texts += ['here token = "ab-10077-x" end', f"see {secret()} there", f"and {secret()}"]
    texts += [f"the sum of 12{k}4567 units" for k in range(20)]
    found = {r["doc_id"]: r for r in pii.find(documents(spark, list(enumerate(texts)))).collect()}
    assert all(found[k]["spans"] == "context:14:54" for k in range(12))
    assert found[12]["spans"] == "context:14:24"
    assert all(found[k]["spans"] == "" for k in range(13, len(texts)))


def test_pieces_of_other_models_and_ids_out_of_range(spark, tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    rng = random.Random(4)
    vocabulary = {}
    while len(vocabulary) < 300:
        word = "".join(rng.choices("abcde1A", k=rng.randint(1, 5)))
        vocabulary.setdefault(rng.choice(["", "\u2581"]) + word, -round(rng.uniform(1, 12), 4))
    vocabulary["\u2581"] = -9.5
    texts = ["".join(rng.choices("abcde  A1ＡＢ①éx日\n \u3000", k=rng.randint(0, 40))) for _ in range(300)]
    for rule, squeeze, byte in (("nfkc", True, True), ("nmt_nfkc_cf", False, False), (None, True, False)):
        model = pb.ModelProto()
        model.trainer_spec.model_type, model.trainer_spec.byte_fallback = 1, byte
        if rule:
            library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
            model.normalizer_spec.ParseFromString(library.serialized_normalizer_spec())
        model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.escape_whitespaces = True
        model.normalizer_spec.remove_extra_whitespaces = squeeze
        entries = [("<unk>", 2, 0.0), ("<s>", 3, 0.0), ("</s>", 3, 0.0)]
        entries += [(f"<0x{b:02X}>", 6, 0.0) for b in range(256)] if byte else []
        for text, kind, score in entries + [(t, 1, s) for t, s in vocabulary.items()]:
            piece = model.pieces.add()
            piece.piece, piece.type, piece.score = text, kind, score
        path = tmp_path / "model"
        path.write_bytes(model.SerializeToString())
        library = sentencepiece.SentencePieceProcessor(model_file=str(path))
        docs = documents(spark, list(enumerate(texts)))
        same = 0
        for r in pieces.encode(docs, str(path)).collect():
            wanted = library.encode(texts[r["doc_id"]])
            same += r["ids"] == wanted
            # Of paths of equal weight another may be taken: the library adds in 32 bits from the start on.
            weight = [sum(library.get_score(i) for i in ids) for ids in (r["ids"], wanted)]
            assert weight[0] == pytest.approx(weight[1], abs=1e-3)
            assert library.decode(r["ids"]) == library.decode(wanted)
        assert same >= 0.98 * len(texts)
    for bad in (-1, 32_000, None):
        rows = spark.createDataFrame([(1, [5, bad])], "doc_id long, ids array<int>")
        with pytest.raises(Exception, match="none of the model's"):
            pieces.decode(rows, queries.PIECE_MODEL).collect()
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["text"] for r in pieces.decode(none, queries.PIECE_MODEL).collect()} == {""}


def test_seams_are_those_that_merging_leaves():
    with open(queries.PIECE_MODEL, "rb") as file:
        machine = pieces.Transducer(file.read())
    import numpy as np

    rng = random.Random(6)
    known = [t for t, s in machine.symbol.items() if s < len(machine.out) and len(t) < 9]
    pairs = [(rng.choice(known), rng.choice(known)) for _ in range(4000)]
    pairs += [(t[:k], t[k:]) for t in rng.sample(known, 800) for k in range(1, len(t)) if t[:k] in machine.symbol and t[k:] in machine.symbol]
    a, b = (np.array([machine.symbol[p[k]] for p in pairs]) for k in (0, 1))
    wanted = [machine._merged(x + y) == [x, y] for x, y in pairs]
    assert machine.apart(a, b).tolist() == wanted
    assert [machine._apart(int(x), int(y)) for x, y in zip(a, b, strict=True)] == wanted
