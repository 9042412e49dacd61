"""Word hashes and shingle sets inside tasks, and groups streamed out of sorted partitions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash

SHINGLE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word; bytes.split() knows the same six blanks as the operators."""
    words = text.encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` numbers."""
    count = max(0, len(hashes) - width + 1)
    out = np.zeros(count, np.uint64)
    for k in range(width):
        out = mixed(out * _STEP + hashes[k : k + count])
    return out


def shingle_set(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, one without words none."""
    hashes = word_hashes(text)
    if 0 < len(hashes) < width:
        return windows(hashes, len(hashes))
    return np.unique(windows(hashes, width))


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Rows that come sorted by ``keys``, in pieces that never cut a group."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        last = tuple(batch[k].iloc[-1] for k in keys)
        open_ = np.ones(len(batch), bool)
        for key, value in zip(keys, last, strict=True):
            open_ &= (batch[key] == value).to_numpy()
        if open_.all() and held and tuple(held[-1][k].iloc[-1] for k in keys) == last:
            held.append(batch)
            continue
        yield pd.concat([*held, batch[~open_]], ignore_index=True)
        held = [batch[open_]]
    if held:
        yield pd.concat(held, ignore_index=True)


def group_edges(rows: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Where groups of sorted rows start, and their end."""
    change = np.zeros(max(len(rows) - 1, 0), bool)
    for key in keys:
        values = rows[key].to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [len(rows)]])
