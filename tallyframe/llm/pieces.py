"""SentencePiece encoding and decoding as shortest paths through a transducer.

A model file is compiled into parts that are composed with each input: the
normaliser (a character map, blanks written as U+2581, a leading blank), an
automaton that reads characters and says which pieces end at each of them, and
byte arcs for characters that no piece covers. Weights add up along a path and
the least sum wins (the tropical semiring).

For unigram models the weight of an arc is the negated score of its piece. For
byte-pair models sums of scores say nothing; there an arc costs nothing, and two
pieces in a row cost infinity if merging would not leave them side by side. That
is read off the order of merges: going back in time from two finished pieces,
their parts that touch at the seam must never have been the best pair to merge.
The beginning of a text is merged in one way only, so of the states (position,
last piece) one at each position has finite weight, and the pass is linear.

Places that no piece spans part a text into units. The distinct units of a batch
go through the pass side by side, a position at a time, as arrays. Nothing is
remembered from one batch to the next, so the work for a text does not depend on
what came before it.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import whole_text
from tallyframe.llm.shingles import mixed

BLANK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Fixed value: how far the score of a character without a piece is below the least one of a unigram model.
UNKNOWN_PENALTY = 10.0
NONE = -1
#: Code points of texts that are worked on at a time.
STRETCH = 1 << 20
#: Longer units are too few to go side by side; they go through the pass by themselves.
LONG = 32

_STEP = 0x9E3779B97F4A7C15


class CharacterMap:
    """The normaliser's rewriting of characters: the longest key at each place is replaced.

    The file holds keys as a double array of 32-bit cells, which is walked once
    to list them, and what they become as strings that end in a zero byte.
    """

    def __init__(self, blob: bytes):
        self.rules: dict[str, dict[str, str]] = {}
        if not blob:
            return
        (size,) = struct.unpack_from("<I", blob)
        cells = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        texts = blob[4 + size :]
        stack = [(self._base(0, cells[0]), b"")]
        while stack:
            base, key = stack.pop()
            for byte in range(1, 256):
                at = base ^ byte
                if at >= len(cells) or cells[at] & 0x800000FF != byte:
                    continue
                longer, below = key + bytes([byte]), self._base(at, cells[at])
                if cells[at] >> 8 & 1:
                    start = cells[below] & 0x7FFFFFFF
                    text = texts[start : texts.index(b"\0", start)].decode()
                    name = longer.decode()
                    self.rules.setdefault(name[0], {})[name] = text
                stack.append((below, longer))
        self.longest = {c: max(map(len, keys)) for c, keys in self.rules.items()}
        self.starts = re.compile(f"[{re.escape(''.join(self.rules))}]")

    @staticmethod
    def _base(at: int, cell: int) -> int:
        return at ^ ((cell >> 10) << ((cell & 0x200) >> 6))

    def apply(self, text: str) -> str:
        if not self.rules:
            return text
        out, at = [], 0
        while (found := self.starts.search(text, at)) is not None:
            start = found.start()
            out.append(text[at:start])
            keys, at = self.rules[text[start]], start + 1
            for size in range(self.longest[text[start]], 0, -1):
                if (new := keys.get(text[start : start + size])) is not None:
                    out.append(new)
                    at = start + size
                    break
            else:
                out.append(text[start])
        out.append(text[at:])
        return "".join(out)


class Table:
    """Numbers by whole-number keys from 0, looked up for arrays: a hash table with an eighth of its slots in use."""

    def __init__(self, entries: dict[int, float], missing: float, kind: type):
        self.bits = max(4, (8 * len(entries)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, NONE), np.full(size, missing, kind)
        keys = np.fromiter(entries.keys(), np.int64, len(entries))
        values = np.fromiter(entries.values(), kind, len(entries))
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == NONE)
            taken, one_of = np.unique(at[free], return_index=True)
            put = free[one_of]
            self.keys[taken], self.values[taken] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & (size - 1)
        self.missing = self.values.dtype.type(missing)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(_STEP) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, asked: np.ndarray) -> np.ndarray:
        at = self._slot(asked)
        held = self.keys[at]
        out = np.where(held == asked, self.values[at], self.missing)
        live = np.flatnonzero((held != asked) & (held != NONE))
        at = at[live]
        while len(live):
            at = at + 1 & (1 << self.bits) - 1
            held = self.keys[at]
            found = held == asked[live]
            out[live[found]] = self.values[at[found]]
            go = ~found & (held != NONE)
            live, at = live[go], at[go]
        return out


class Transducer:
    """A compiled model. Symbols are its pieces, by id, and after them the characters that are no piece."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that write blanks before words are supported")
        kind = proto.trainer_spec.model_type
        if kind not in (UNIGRAM, BPE) or any(p.type in (USER, UNUSED) for p in proto.pieces):
            raise ValueError("only unigram and byte-pair models of plain pieces are supported")
        self.merges = kind == BPE
        self.map = CharacterMap(norm.precompiled_charsmap)
        self.squeeze = norm.remove_extra_whitespaces
        self.prefix = BLANK if norm.add_dummy_prefix else ""
        self.out: list[bytes] = []
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        ids: dict[str, int] = {}
        for i, p in enumerate(proto.pieces):
            data = b""
            if p.type == NORMAL:
                ids[p.piece], data = i, p.piece.replace(BLANK, " ").encode()
            elif p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
                data = bytes([int(p.piece[1:-1], 16)])
            elif p.type == UNKNOWN:
                self.unknown, data = i, " ⁇ ".encode()
            self.out.append(data)
        self.byte_ids = np.zeros(len(self.out), bool)
        self.byte_ids[list(self.bytes.values())] = True
        self.rank = {text: proto.pieces[i].score for text, i in ids.items()}
        self._number(ids)
        self._compile(ids)

    # ---- compiling ----

    def _number(self, ids: dict[str, int]) -> None:
        """Codes of the characters in pieces, from 1; 0 is any other. Symbols of pieces and of lone characters."""
        letters = sorted({c for text in ids for c in text})
        self.codes = np.zeros(0x110000, np.int32)
        self.codes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.n_codes = len(letters) + 1
        self.symbol = dict(ids)
        for code, c in enumerate(letters, 1):
            self.symbol.setdefault(c, len(self.out) + code)
        self.n_symbols = len(self.out) + self.n_codes
        self.spelled = {s: c for c, s in self.symbol.items() if s >= len(self.out)}

    def _derived(self, text: str) -> tuple | None:
        """(text, left, right) of the merges that make a piece, if merging makes it at all."""
        parts = [(c, None, None) for c in text]
        while len(parts) > 1:
            scores = [self.rank.get(a[0] + b[0]) for a, b in zip(parts, parts[1:])]
            best = max((s for s in scores if s is not None), default=None)
            if best is None:
                return None
            at = scores.index(best)
            parts[at : at + 2] = [(parts[at][0] + parts[at + 1][0], parts[at], parts[at + 1])]
        return parts[0]

    def _compile(self, ids: dict[str, int]) -> None:
        size, n = self.n_symbols, self.n_codes
        self.size = np.ones(size, np.int64)
        self.born = np.full(size, np.inf)
        self.left, self.right = np.full(size, NONE), np.full(size, NONE)
        self.odd = np.zeros(size, bool)
        self.cost = np.full(size, np.nan)
        least = min(self.rank.values(), default=0.0)
        self.cost[list(self.symbol.values())] = UNKNOWN_PENALTY - least
        self.lone_cost = UNKNOWN_PENALTY - least
        self.meets: dict[int, float] = {}
        arcs, spans = set(), np.zeros(n * n, bool)
        for text in sorted(self.symbol, key=len):
            s = self.symbol[text]
            self.size[s] = len(text)
            if text in ids:
                self.cost[s] = -self.rank[text]
                for at in range(1, len(text)):
                    a, b = self.symbol.get(text[:at]), self.symbol.get(text[at:])
                    if a is not None and b is not None:
                        self.meets[a * size + b] = self.rank[text]
            if len(text) > 1 and self.merges:
                made = self._derived(text)
                if made is None:
                    continue
                a, b = (self.symbol[part[0]] for part in made[1:])
                self.left[s], self.right[s], self.born[s] = a, b, self.rank[text]
                # Where a part does not come clearly before the whole, time cannot be read off the scores.
                self.odd[s] = self.odd[a] or self.odd[b] or min(self.born[a], self.born[b]) <= self.born[s]
            arcs.add(text)
            codes = self.codes[[ord(c) for c in text]].astype(np.int64)
            spans[codes[:-1] * n + codes[1:]] = True
        self.spans = spans
        self.cost = self.cost.astype(np.float32)  # as files hold them and as sums are compared
        self.lone_cost = np.float32(self.lone_cost)
        self.merge_score = Table(self.meets, -np.inf, float)
        self._automaton(arcs)
        self._seams: dict[int, bool] = {}

    def _automaton(self, arcs: set[str]) -> None:
        """States that read characters; of each, the longest symbol that ends there, and of symbols the next shorter."""
        n, step, ends, depth = self.n_codes, {}, {}, [[0]]
        children: list[list[tuple[int, int]]] = [[]]
        for text in arcs:
            at = 0
            for c in text:
                code = int(self.codes[ord(c)])
                to = step.get(at * n + code)
                if to is None:
                    to = step[at * n + code] = len(children)
                    children.append([])
                    children[at].append((code, to))
                at = to
            ends[at] = self.symbol[text]
        fail, longest = [0] * len(children), [NONE] * len(children)
        shorter = np.full(self.n_symbols, NONE)
        while depth[-1]:
            below = []
            for at in depth[-1]:
                for code, to in children[at]:
                    back = fail[at]
                    while at and back and back * n + code not in step:
                        back = fail[back]
                    fail[to] = step.get(back * n + code, 0) if at else 0
                    longest[to] = longest[fail[to]]
                    if to in ends:
                        shorter[ends[to]], longest[to] = longest[to], ends[to]
                    below.append(to)
            depth.append(below)
        self.steps, self.step = step, Table(step, NONE, np.int64)
        self.fail, self.longest, self.shorter = np.array(fail), np.array(longest), shorter
        names = ("fail", "longest", "shorter", "size", "left", "right", "born", "odd", "cost")
        self.plain = {name: getattr(self, name).tolist() for name in names}

    # ---- arcs of infinite weight ----

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            scores = [self.rank.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(scores)
            if best == -np.inf:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _odd_seam(self, a: int, b: int) -> bool:
        """The same for pieces whose merges are not in the order of their scores, by merging."""
        key = a * self.n_symbols + b
        if key not in self._seams:
            one, two = ((self.spelled.get(s) or self.out[s].decode().replace(" ", BLANK)) for s in (a, b))
            self._seams[key] = self._merged(one + two) == [one, two]
        return self._seams[key]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves symbols ``a`` and ``b`` side by side, for arrays of them."""
        out = np.ones(len(a), bool)
        odd = self.odd[a] | self.odd[b]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._odd_seam(int(a[i]), int(b[i]))
        live = np.flatnonzero(~odd)
        x, y = a[live], b[live]
        end_x, end_y = np.full(len(live), -np.inf), np.full(len(live), -np.inf)
        while len(live):
            seam = self.merge_score.get(x * self.n_symbols + y)
            # While x and y lay side by side, until one of them was merged away: of equal scores the left is first.
            merged = (seam > end_x) & (seam >= end_y)
            out[live[merged]] = False
            born_x, born_y = self.born[x], self.born[y]
            go = ~merged & ~(np.isinf(born_x) & np.isinf(born_y))
            back_x = born_x < born_y
            end_x, end_y = np.where(back_x, born_x, end_x)[go], np.where(back_x, end_y, born_y)[go]
            x, y = np.where(back_x, self.right[x], x)[go], np.where(back_x, y, self.left[y])[go]
            live = live[go]
        return out

    def _apart(self, a: int, b: int) -> bool:
        """``apart`` of two symbols."""
        own = self.plain
        if own["odd"][a] or own["odd"][b]:
            return self._odd_seam(a, b)
        born, left, right = own["born"], own["left"], own["right"]
        end_a = end_b = never = float("-inf")
        while True:
            seam = self.meets.get(a * self.n_symbols + b, never)
            if seam > end_a and seam >= end_b:
                return False
            if born[a] < born[b]:
                a, end_a = right[a], born[a]
            elif born[b] < float("inf"):
                b, end_b = left[b], born[b]
            else:
                return True

    # ---- paths ----

    def _long_path(self, codes: list[int]) -> list[int]:
        """The last symbol at each position of one unit."""
        own, n, steps = self.plain, self.n_codes, self.steps
        fail, longest, shorter, size = (own[k] for k in ("fail", "longest", "shorter", "size"))
        last, cost, state = [NONE] * (len(codes) + 1), [np.float32(0)], 0
        seams: dict[tuple[int, int], bool] = {}
        for at, code in enumerate(codes, 1):
            while (to := steps.get(state * n + code)) is None and state:
                state = fail[state]
            state = to or 0
            symbol = longest[state]
            if not self.merges:
                best = None
                while symbol != NONE:
                    total = cost[at - size[symbol]] + self.cost[symbol]
                    if best is None or total < best:
                        best, last[at] = total, symbol
                    symbol = shorter[symbol]
                cost.append(best)
                continue
            while symbol != NONE:
                before = at - size[symbol]
                if not before:
                    break
                seam = (last[before], symbol)
                if seam not in seams:
                    seams[seam] = self._apart(*seam)
                if seams[seam]:
                    break
                symbol = shorter[symbol]
            if symbol == NONE:
                raise ValueError("no path; the model's merges contradict each other")
            last[at] = symbol
        return last

    def _next_states(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        out, live = np.zeros(len(state), np.int64), np.flatnonzero(code)
        at, code = state[live], code[live]
        while len(live):
            to = self.step.get(at * self.n_codes + code)
            out[live] = np.maximum(to, 0)
            go = (to == NONE) & (at != 0)
            live, at, code = live[go], self.fail[at[go]], code[go]
        return out

    def paths(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last symbol at each position, place of each unit's positions) of units of ``codes``.

        Positions of a unit are 0 to its length; a character of code 0 is a symbol by itself, ``NONE``.
        """
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        base = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        last = np.full(int((size + 1).sum()), NONE)
        cost = None if self.merges else np.zeros(len(last), np.float32)
        n_long = int(np.searchsorted(-size, -LONG))
        for i in range(n_long):
            own = codes[start[i] : start[i] + size[i]].tolist()
            last[base[i] : base[i] + size[i] + 1] = self._long_path(own)
        where = np.empty(len(order), np.int64)
        where[order] = base
        start, size, base = start[n_long:], size[n_long:], base[n_long:]
        state = np.zeros(len(size), np.int64)
        alive = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), "right")
        for at, n in enumerate(alive.tolist(), 1):
            code = codes[start[:n] + at - 1].astype(np.int64)
            state = self._next_states(state[:n], code)
            symbol = np.where(code > 0, self.longest[state], NONE)
            if self.merges:
                self._merge_step(last, base, at, symbol)
            else:
                self._cost_step(last, cost, base, at, symbol)
        return last, where

    def _merge_step(self, last: np.ndarray, base: np.ndarray, at: int, symbol: np.ndarray) -> None:
        live = np.flatnonzero(symbol != NONE)
        symbol = symbol[live]
        while len(live):
            before = at - self.size[symbol]
            ok = before == 0
            rest = np.flatnonzero(~ok)
            ok[rest] = self.apart(last[base[live[rest]] + before[rest]], symbol[rest])
            last[base[live[ok]] + at] = symbol[ok]
            live, symbol = live[~ok], self.shorter[symbol[~ok]]
            if (symbol == NONE).any():
                raise ValueError("no path; the model's merges contradict each other")

    def _cost_step(
        self, last: np.ndarray, cost: np.ndarray, base: np.ndarray, at: int, symbol: np.ndarray
    ) -> None:
        here = base[: len(symbol)] + at
        cost[here] = np.where(symbol == NONE, cost[here - 1] + self.lone_cost, np.float32(np.inf))
        live = np.flatnonzero(symbol != NONE)
        symbol = symbol[live]
        while len(live):
            total = cost[here[live] - self.size[symbol]] + self.cost[symbol]
            less = total < cost[here[live]]
            cost[here[live[less]]], last[here[live[less]]] = total[less], symbol[less]
            symbol = self.shorter[symbol]
            live, symbol = live[symbol != NONE], symbol[symbol != NONE]

    def _tokens(self, points: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many) of units of code points, by walking their paths back."""
        last, base = self.paths(self.codes[points], start, size)
        unit, at, steps = np.arange(len(size)), size.copy(), []
        while len(unit):
            symbol = last[base[unit] + at]
            length = np.where(symbol == NONE, 1, self.size[symbol])
            steps.append((unit, at - length, symbol, points[start[unit] + at - length]))
            at = at - length
            unit, at = unit[at > 0], at[at > 0]
        if not steps:
            return np.zeros(0, np.int32), np.zeros(len(size), np.int64)
        unit, at, symbol, point = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.lexsort((at, unit))
        unit, symbol, point = unit[order], symbol[order], point[order]
        lone = (symbol == NONE) | (symbol >= len(self.out))
        times = np.ones(len(unit), np.int64)
        spelled = {}
        for c in set(point[lone].tolist()):
            spelled[c] = [self.bytes[b] for b in chr(c).encode()] if self.bytes else [self.unknown]
        where = np.flatnonzero(lone)
        written = [spelled[c] for c in point[where].tolist()]
        times[where] = [len(w) for w in written]
        ids = np.repeat(symbol, times)
        if len(where):
            first = np.cumsum(times) - times
            spots = np.repeat(first[where], times[where]) + np.concatenate([np.arange(len(w)) for w in written])
            ids[spots] = np.concatenate(written)
        return ids.astype(np.int32), np.bincount(unit, times, minlength=len(size)).astype(np.int64)

    # ---- texts ----

    def normalised(self, text: str) -> str:
        """The text as pieces spell it."""
        text = self.map.apply(text)
        if self.squeeze:
            text = re.sub(f"[ {BLANK}]+" if BLANK in text else " +", " ", text).strip(f" {BLANK}")
        return self.prefix + text.replace(" ", BLANK) if text else ""

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, texts of up to ``STRETCH`` code points at a time."""
        held: list[str] = []
        size = 0
        for text in texts:
            spelled = self.normalised(text)
            if held and size + len(spelled) > STRETCH:
                yield from self._encode(held)
                held, size = [], 0
            held.append(spelled)
            size += len(spelled)
        yield from self._encode(held)

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        if not len(points):
            yield from (np.zeros(0, np.int32) for _ in texts)
            return
        code = self.codes[points].astype(np.int64)
        cut = np.ones(len(points) + 1, bool)
        cut[1:-1] = ~self.spans[code[:-1] * self.n_codes + code[1:]]
        cut[ends] = True
        start = np.flatnonzero(cut[:-1])
        size = np.diff(np.append(start, len(points)))
        one_of, which = _distinct(points, start, size)
        ids, count = self._tokens(points, start[one_of], size[one_of])
        times = count[which]
        first = (np.cumsum(count) - count)[which]
        total = np.cumsum(times)
        spots = np.repeat(first - (total - times), times) + np.arange(int(total[-1]))
        ids = ids[spots]
        upto = np.concatenate([[0], total])[np.searchsorted(start, ends)]
        for low, high in zip(np.concatenate([[0], upto[:-1]]), upto, strict=True):
            own = ids[low:high]
            if not self.bytes and len(own):
                # Unknown characters in a row are one.
                again = (own[1:] == self.unknown) & (own[:-1] == self.unknown)
                own = own[np.append(True, ~again)]
            yield own

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; ids that the model does not have are an error."""
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.out):
            raise ValueError(f"an id that is none of the model's 0 to {len(self.out) - 1}")
        text = b"".join(map(self.out.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_POWERS: list[np.ndarray] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, made once in a worker."""
    if not _POWERS or len(_POWERS[0]) < count:
        _POWERS.clear()
        for base in (_STEP, pow(_STEP, -1, 2**64)):
            row = np.full(max(count, STRETCH + 1), base, np.uint64)
            row[0] = 1
            _POWERS.append(np.multiply.accumulate(row))
    return _POWERS[0][:count], _POWERS[1][:count]


def _distinct(points: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one unit of each kind, the kind of each unit); units are compared by hash and then in full."""
    powers, down = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mixed(points.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    hashes = mixed((sums[start + size] - sums[start]) * down[start]) + size.astype(np.uint64)
    _, one_of, which = np.unique(hashes, return_index=True, return_inverse=True)
    inside = np.arange(len(points)) - np.repeat(start, size)
    unlike = size[one_of][which] != size
    same_size = np.repeat(~unlike, size)
    other = np.repeat(start[one_of][which], size) + inside
    wrong = same_size & (points[np.where(same_size, other, 0)] != points)
    unlike |= np.add.reduceat(wrong, start) > 0
    # A unit that only shares the hash is a kind of its own.
    extra = np.flatnonzero(unlike)
    which[extra] = len(one_of) + np.arange(len(extra))
    return np.concatenate([one_of, extra]), which


_COMPILED: dict[str, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """The model of a Python worker, compiled once."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _COMPILED:
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def encode(docs: DataFrame, model_path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, ids, n_tokens, n_byte_tokens, ids_sha256, round_trip: one row a row.

    ``ids_sha256`` is over the ids as little-endian 32-bit numbers, and
    ``round_trip`` tells whether decoding gives the normalised text again (U+2581
    comes back as a blank). Null counts as empty: no ids. Other columns are not
    looked at.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = compiled(model.value)
        for rows in batches:
            out = []
            texts = rows.pop("text").tolist()
            for text, ids in zip(texts, machine.encode_all(texts), strict=True):
                plain = machine.normalised(text)[len(machine.prefix) :].replace(BLANK, " ")
                back = machine.decode(ids) == plain
                n_bytes = int(machine.byte_ids[ids].sum())
                digest = hashlib.sha256(ids.tobytes()).hexdigest()
                out.append((ids if with_ids else None, len(ids), n_bytes, digest, back))
            rows[["ids", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip"]] = (
                pd.DataFrame(out, columns=range(5), index=rows.index, dtype=object)
            )
            yield rows

    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(
        run,
        "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long, "
        "ids_sha256 string, round_trip boolean",
    )


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of rows of (doc_id, ids); null ids give an empty text.

    An id that the model does not have, or null among the ids, fails the job.
    """
    with open(model_path, "rb") as file:
        model = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = compiled(model.value)
        for rows in batches:
            rows["text"] = [machine.decode(np.asarray(ids, np.int64)) for ids in rows.pop("ids")]
            yield rows

    none = F.array().cast("array<int>")
    whole = F.transform(F.coalesce("ids", none), lambda i: F.coalesce(i, F.lit(NONE)))
    return encoded.select("doc_id", whole.alias("ids")).mapInPandas(run, "doc_id long, text string")
