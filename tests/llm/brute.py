"""Plain versions of the operators, one document after the other."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- 1 and 6 ----


def byte_strings(texts, width):
    data = [(t or "").encode() for t in texts]
    times = Counter(x[i : i + width] for x in data for i in range(len(x) - width + 1))
    out = []
    for x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - width + 1):
            if times[x[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(v for v, g in zip(x, gone) if not g)
        spans = sum(1 for i in range(len(x)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(x), sum(gone), spans, sha(kept)))
    return out


def word_windows(texts, width):
    lists, first, out = [words(t) for t in texts], {}, []
    for i, w in enumerate(lists):
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    for i, w in enumerate(lists):
        gone = [0] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [1] * width
        out.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


# ---- 2 ----


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def private(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in KINDS.items()
        for m in re.finditer(pattern, text or "")
        if _holds(kind, m[0])
    ]


def redacted(text, mark="[PRIVATE]"):
    out, at = "", 0
    for start, end in sorted(x[1:] for x in private(text)):
        if start >= at:
            out += text[at:start] + mark
        at = max(at, end)
    return out + text[at:]


# ---- 4 ----


def line_dedup(rows, least=10):
    """{id: (lines, dropped, kept text)}"""
    owner = {}
    for i, text in sorted(rows):
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= least:
                owner.setdefault(key, i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if owner.get(x.strip(BLANKS).translate(LOWER), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


# ---- 8 ----


def measured(text):
    w = words(text)
    places = defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    failed = n < 10 or 100 * len(covered) > 20 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def _grams(w, buckets=262_144):
    hashes = [zlib.crc32(x.encode()) for x in w]
    return [h % buckets for h in hashes] + [(31 * x + y) % buckets for x, y in pairwise(hashes)]


def kept_by_quality(rows, good, threshold=-0.35, buckets=262_144):
    raw, trusted = Counter(), Counter()
    for i, text in rows:
        grams = _grams(words(text), buckets)
        raw.update(grams)
        if i in good:
            trusted.update(grams)
    n, m = sum(trusted.values()), sum(raw.values())
    kept = []
    for i, text in rows:
        grams = _grams(words(text), buckets)
        if measured(text)[5]:
            continue
        score = sum(math.log((trusted[g] / (raw[g] / m) + buckets) / (n + buckets)) for g in grams)
        if score / len(grams) >= threshold:
            kept.append((i, text))
    return kept


# ---- 9 ----


def near(rows, threshold=0.8):
    """{id: (class, copy of, copies, links)}"""
    sets = defaultdict(list)
    for i, text in sorted(rows):
        w = words(text)
        n = min(5, len(w))
        sets[frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset()].append(i)
    reps = [(ids[0], s) for s, ids in sets.items() if s]
    holders, links, root = defaultdict(list), defaultdict(set), {}
    for at, (i, s) in enumerate(reps):
        common = Counter()
        for g in s:
            common.update(holders[g])
            holders[g].append(at)
        for other, c in common.items():
            j, t = reps[other]
            if c >= threshold * (len(s) + len(t) - c) - 1e-9:
                links[i].add(j)
                links[j].add(i)

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i in links:
        for j in links[i]:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {
        i: (find(ids[0]), ids[0], len(ids), len(links[ids[0]])) for ids in sets.values() for i in ids
    }


# ---- 10 ----


def best_fit(lengths, sizes, bin_cost):
    """Bins of a list that comes longest first, by looking at every bin and every length."""
    bins, rest = [], list(lengths)
    for n in lengths:
        rest.remove(n)
        open_ = [(room - n, k) for k, (room, _) in enumerate(bins) if room >= n]
        if open_:
            k = min(open_)[1]
            bins[k] = (bins[k][0] - n, [*bins[k][1], n])
            continue

        def cost(size):
            room = size - n
            for other in sorted(rest, reverse=True):
                if other <= room:
                    room -= other
            return (size + bin_cost) / (size - room), size

        size = min((s for s in sizes if s >= n), key=cost)
        bins.append((size - n, [n]))
    return sorted((sum(x), min(s for s in sizes if s >= sum(x))) for _, x in bins)


# ---- 11 ----


def whitened(vectors, most):
    """(n, deviation of each, whitened of each, explained) of lists of whole entries, by plain formulas."""
    from fractions import Fraction

    import numpy as np

    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(row[j] for row in x) for j in range(width)]
    centred = [[n * row[j] - sums[j] for j in range(width)] for row in x]
    matrix = np.array(
        [
            [float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(width)]
            for i in range(width)
        ]
    )
    values, basis = np.linalg.eigh(matrix)
    values, basis = values[::-1][:most], basis[:, ::-1][:, :most]
    deviation = [sum(v * v for v in row) for row in centred]
    there = (np.array(centred, float) / n) @ basis / np.sqrt(values)
    return n, deviation, there, values / np.trace(matrix)


# ---- 13 ----


def aligned(texts, byte_level_path, pieces_path):
    """The row of each text, by both libraries and offset by offset."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_of = Tokenizer.from_file(byte_level_path)
    a_of.encode_special_tokens = True
    b_of = SentencePieceProcessor(model_file=pieces_path)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict(zip(map(chr, printable), printable, strict=True))
    for b in sorted(set(range(256)) - set(printable)):
        letters[chr(256 + sum(x not in printable for x in range(b)))] = b

    def of_a(i):
        return bytes(letters[c] for c in a_of.id_to_token(i))

    def of_b(i):
        piece = b_of.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if b_of.is_byte(i) else piece.replace("\u2581", " ").encode()

    def ends(ids, of):
        at, out = 0, []
        for i in ids:
            at += len(of(i))
            out.append(at)
        return out

    found, counts = [], Counter()
    for text in texts:
        data = (" " + text).encode() if text else b""
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        if b"".join(map(of_a, a)) != data or b"".join(map(of_b, b)) != data:
            a, b = [], []
        ends_a, ends_b = ends(a, of_a), ends(b, of_b)
        links, groups, from_a, from_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end, from_a) + 1, ends_b.index(end, from_b) + 1
            groups.append(",".join(map(str, a[from_a:to_a])) + "|" + ",".join(map(str, b[from_b:to_b])))
            links.append((a[to_a - 1], b[to_b - 1]))
            from_a, from_b = to_a, to_b
        counts.update(links)
        found.append((len(a), len(b), len(groups), links, sha(";".join(groups)) if groups else ""))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links),
         sum(counts[x] for x in links), digest)
        for n_a, n_b, n_groups, links, digest in found
    ]
