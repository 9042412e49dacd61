"""Cross-tokenizer alignment of every text, worked out once for each distinct text.

Texts are shuffled by their full text and reduced to one row with the number of
copies. Each distinct text is encoded by both tokenizers and aligned once; its
links count as often as it has copies, and its measures are joined back to the
documents by the text's digest.

A link's two tokens end at the same byte, so one's bytes are a suffix of the
other's. Only so many pairs of ids can ever be linked: for the given vocabularies
fewer than the bytes of all their entries, whatever the corpus. This list of
possible pairs is made from the vocabularies, and corpus-wide counts are one
number for each of them, which is what tasks send, the driver gets and the
executors are given back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import whole_text, write_out

#: Code points after which a text is cut at the next place that no token can cross.
CHUNK = 1 << 16

# The published pre-tokenizer pattern of byte-level vocabularies.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Byte-level byte-pair tokenizer of a ``tokenizers`` file, without special tokens."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        vocabulary = spec["model"]["vocab"]
        letters = byte_letters()
        special = {t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *special]))
        for token, i in vocabulary.items():
            if i not in special:
                self.bytes[i] = bytes(letters[c] for c in token)
        self._ranks = self._by_rank(spec, special)
        self._file = file
        self._encode = None

    def _by_rank(self, spec: dict, special: set[int]) -> dict[bytes, int] | None:
        """Ranks for the faster library, if ids stand in the order of merges and nothing else is set."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and not spec.get("normalizer")
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "ignore_merges", "unk_token"))
            and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        )
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        ids = [model["vocab"].get(a + b) for a, b in merges]
        if not plain or ids != sorted(ids, key=lambda i: -1 if i is None else i) or None in ids:
            return None
        ranks = {b: i for i, b in enumerate(self.bytes) if i not in special and b}
        return ranks if all(bytes([b]) in ranks for b in range(256)) else None

    def encode(self, text: str) -> list[int]:
        if self._encode is None:
            self._encode = self._encoder()
        return self._encode(text)

    def _encoder(self):
        if self._ranks is not None:
            import tiktoken

            library = tiktoken.Encoding(
                "byte-level", pat_str=WORD_PATTERN, mergeable_ranks=self._ranks, special_tokens={}
            )
            return library.encode_ordinary
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(self._file)
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """SentencePiece tokenizer that puts a blank before a text."""

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor

        self._library = SentencePieceProcessor(model_proto=file)
        self.bytes = []
        inner = False
        for i in range(self._library.get_piece_size()):
            piece = self._library.id_to_piece(i)
            if self._library.is_byte(i):
                self.bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())
                inner |= "▁" in piece.lstrip("▁")
        #: Whether no piece goes across a blank that follows another character.
        self.cuts = not inner

    def encode(self, text: str) -> list[int]:
        return self._library.encode(text)


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """``a_id * len(b) + b_id`` of all ids of which one's bytes end in the other's, in order."""
    of_a, of_b = {}, {}
    for tokens, of in ((a, of_a), (b, of_b)):
        for i, data in enumerate(tokens):
            if data:
                of.setdefault(data, []).append(i)
    found = set()
    for one, other, flip in ((of_a, of_b, False), (of_b, of_a, True)):
        for data, ids in one.items():
            for start in range(len(data)):
                for j in other.get(data[start:], ()):
                    found.update((j * len(b) + i) if flip else (i * len(b) + j) for i in ids)
    return np.array(sorted(found), np.int64)


def _written_ids(count: int, after: str) -> np.ndarray:
    """Each id as text and what follows it, as eight bytes in one number, padded with zeros."""
    if count > 10_000_000:
        raise ValueError("ids of more than seven digits")
    rows = b"".join(f"{i}{after}".encode().ljust(8, b"\0") for i in range(count))
    return np.frombuffer(rows, np.uint64)


class Aligner:
    """Both tokenizers, and the alignment of one text."""

    def __init__(self, a_file: bytes, b_file: bytes, pairs: np.ndarray):
        self.a, self.b, self.pairs = ByteLevel(a_file), Pieces(b_file), pairs
        self.size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes], np.int64)
        most = max(len(self.size_a), len(self.size_b))
        self.text = {after: _written_ids(most, after) for after in ",|;"}

    def chunks(self, text: str) -> Iterator[str]:
        """The text with a blank before it, cut before single blanks that no token of either kind crosses."""
        whole, at = f" {text}", 0
        while self.b.cuts and len(whole) - at > CHUNK:
            place = _CUT.search(whole, at + CHUNK)
            if place is None:
                break
            yield whole[at : place.start()]
            at = place.start()
        yield whole[at:]

    def groups(self, chunk: str):
        """(ids of A, ids of B, which are last in their group), or None if bytes differ."""
        data = chunk.encode()
        a, b = self.a.encode(chunk), self.b.encode(chunk[1:])
        if b"".join(map(self.a.bytes.__getitem__, a)) != data:
            return None
        if b"".join(map(self.b.bytes.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        here = np.zeros((2, len(data) + 1), bool)
        here[0, ends_a] = here[1, ends_b] = True
        return a, b, here[1, ends_a], here[0, ends_b]

    def written(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3;`` of a chunk."""
        # Tokens of B that stand before each group, and tokens of A up to the end of it.
        before = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        until = np.flatnonzero(last_a) + 1
        place_a = np.arange(len(a)) + before[np.cumsum(last_a) - last_a]
        place_b = np.arange(len(b)) + until[np.cumsum(last_b) - last_b]
        out = np.empty(len(a) + len(b), np.uint64)
        out[place_a] = np.where(last_a, self.text["|"][a], self.text[","][a])
        out[place_b] = np.where(last_b, self.text[";"][b], self.text[","][b])
        flat = out.view(np.uint8)
        return flat[flat != 0].tobytes()

    def measures(self, text: str):
        """(n_a, n_b, n_groups, groups_sha256, links, their numbers) of a text; None if bytes differ anywhere."""
        n_a = n_b = n_groups = 0
        digest, held, links = hashlib.sha256(), b"", []
        for chunk in self.chunks(text):
            found = self.groups(chunk)
            if found is None:
                return None
            a, b, last_a, last_b = found
            codes = a[last_a] * len(self.size_b) + b[last_b]
            n_a, n_b, n_groups = n_a + len(a), n_b + len(b), n_groups + len(codes)
            digest.update(held)
            held = self.written(a, b, last_a, last_b)
            codes, times = np.unique(codes, return_counts=True)
            links.append((np.searchsorted(self.pairs, codes), times))
        digest.update(held[:-1])
        pairs, times = links[0]
        if len(links) > 1:
            pairs, where = np.unique(np.concatenate([p for p, _ in links]), return_inverse=True)
            times = np.bincount(where, np.concatenate([t for _, t in links])).astype(np.int64)
        return n_a, n_b, n_groups, digest.hexdigest(), pairs, times


_ALIGNERS: dict[str, Aligner] = {}


def _aligner(a_file: bytes, b_file: bytes, pairs: np.ndarray) -> Aligner:
    """The tokenizers of a Python worker, loaded once."""
    key = hashlib.sha256(a_file + b_file).hexdigest()
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_file, b_file, pairs)
    return _ALIGNERS[key]


_MEASURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_SHAPE = "key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def aligned_texts(docs: DataFrame, a_file: bytes, b_file: bytes, pairs: np.ndarray) -> DataFrame:
    """One row a distinct text that is not empty: its digest, copies, measures and links."""
    given = docs.sparkSession.sparkContext.broadcast((a_file, b_file, pairs))
    text = whole_text()
    distinct = docs.select(text.alias("text")).filter("text <> ''").groupBy("text")
    rows = distinct.agg(F.count("*").alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*given.value)
        none = np.zeros(0, np.int64)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                found = aligner.measures(text) or (0, 0, 0, "", none, none)
                n_a, n_b, n_groups, digest, links, times = found
                out.append((n_a, n_b, n_groups, int(times.sum()), digest, links, times))
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    *[pa.array(c, pa.int64()) for c in columns[:4]],
                    pa.array(columns[4], pa.string()),
                    _lists(list(columns[5]), pa.int32()),
                    _lists(list(columns[6]), pa.int32()),
                ],
                ["key", "copies", *_MEASURES, "links", "times"],
            )

    asked = rows.select(F.sha2("text", 256).alias("key"), "text", "copies")
    return write_out(asked.mapInArrow(run, f"{_SHAPE}, links array<int>, times array<int>"), "alignments")


def pair_counts(texts: DataFrame, size: int) -> DataFrame:
    """(pair, n): links of each possible pair over the corpus, copies included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            copies = batch.column(0).to_numpy()
            links, times = batch.column(1), batch.column(2)
            lengths = np.diff(links.offsets.to_numpy())
            weights = times.flatten().to_numpy().astype(np.int64) * np.repeat(copies, lengths)
            np.add.at(total, links.flatten().to_numpy(), weights)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array(total[held])], ["pair", "n"])

    rows = texts.select("copies", "links", "times")
    return rows.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _best(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id."""
    most = np.zeros(int(of.max(initial=-1)) + 1, np.int64)
    np.maximum.at(most, of, counts)
    return counts == most[of] if len(of) else np.zeros(0, bool)


def counted(texts: DataFrame, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """The measures of each distinct text, with those that depend on corpus counts."""
    given = texts.sparkSession.sparkContext.broadcast((counts, best))
    names = ["key", *_MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = given.value
        for batch in batches:
            links, times = batch.column(len(names)), batch.column(len(names) + 1)
            ends = links.offsets.to_numpy() - links.offsets[0].as_py()
            pairs, n = links.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in (n * best[pairs], n * counts[pairs])]
            extra = [pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums]
            yield pa.record_batch([*batch.columns[: len(names)], *extra], [*names, "n_best", "count_sum"])

    shape = _SHAPE.replace("copies long, ", "") + ", n_best long, count_sum long"
    return texts.select(*names, "links", "times").mapInArrow(run, shape)


@dataclass(frozen=True)
class Alignment:
    """``documents``: one row a document. ``pairs``: a_id, b_id, n, best of each pair that is linked."""

    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, byte_level_path: str, pieces_path: str) -> Alignment:
    """Align the tokens of two tokenizers in every text of (doc_id, text).

    A is a byte-level byte-pair tokenizer, given a blank and the text; B is a
    SentencePiece model, which adds the blank. Places where tokens of both end
    cut a text into groups, and the two tokens that end there are linked. A
    text that is null, empty, or not given back byte by byte by both has no tokens:
    zeros and an empty ``groups_sha256``. Rows with null or repeated ids are
    documents of their own. Other columns are not looked at. Texts are worked on
    in chunks, cut where no token of either kind can cross; a text without single
    blanks is one chunk.
    """
    spark = docs.sparkSession
    with open(byte_level_path, "rb") as a, open(pieces_path, "rb") as b:
        a_file, b_file = a.read(), b.read()
    a_bytes, b_bytes = ByteLevel(a_file).bytes, Pieces(b_file).bytes
    pairs = possible_pairs(a_bytes, b_bytes)
    texts = aligned_texts(docs, a_file, b_file, pairs)
    counts = np.zeros(len(pairs), np.int64)
    # At most one row for each possible pair.
    seen = pair_counts(texts, len(pairs)).toArrow()
    counts[seen["pair"].to_numpy()] = seen["n"].to_numpy()
    best = _best(counts, pairs % len(b_bytes))
    measured = counted(texts, counts, best)
    key = F.sha2(whole_text(), 256)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"))
    numbers = [*_MEASURES[:4], "n_best", "count_sum"]
    joined = rows.join(measured.hint("merge"), "key", "left").select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
    held = np.flatnonzero(counts)
    table = pa.table(
        {
            "a_id": pairs[held] // max(len(b_bytes), 1),
            "b_id": pairs[held] % max(len(b_bytes), 1),
            "n": counts[held],
            "best": best[held],
        }
    )
    return Alignment(joined, spark.createDataFrame(table))
