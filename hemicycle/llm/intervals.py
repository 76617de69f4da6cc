"""Common prefixes up to a bound by breadth-first expansion over a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

#: Bits of a symbol: 256 bytes and a separator, which is zero.
SYMBOL_BITS = 9
FIRST = 63 // SYMBOL_BITS


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more, by doubled ranks.

    The text goes on from its beginning after its end, as its transform does.
    """
    n = len(text)
    padded = np.resize(text.astype(np.int64), n + FIRST)
    key = np.zeros(n, dtype=np.int64)
    for k in range(FIRST):
        key = (key << SYMBOL_BITS) | padded[k : k + n]
    known = FIRST
    while True:
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank_sorted = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        if known >= depth or rank_sorted[-1] == n - 1:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = rank_sorted + 1
        key = (rank << 32) | np.roll(rank, -known)
        known *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each neighbouring pair of suffixes their common prefix if it is below ``least``, else -1.

    Entry ``k`` belongs to the suffixes ``k - 1`` and ``k``. The interval of a string holds
    the suffixes that begin with it; a step puts one symbol in front of each string of the
    frontier. An interval that ends where no value is known yet sets it to the length so
    far and joins the next frontier, so values appear in rising order and each is set once;
    the expansion ends at ``least``.
    """
    n = len(text)
    before = text[order - 1]  # the transform; in front of the text stands its end
    by_symbol = np.argsort(before, kind="stable")
    moved = np.empty(n, dtype=np.int64)
    moved[by_symbol] = np.arange(n)
    prefix = np.full(n + 1, -1, dtype=np.int64)
    prefix[0] = prefix[n] = 0
    low, high = np.array([0]), np.array([n])
    for length in range(least):
        sizes = high - low
        place = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        owner = np.repeat(np.arange(len(low)), sizes)
        # Places rise, so this orders the moved places as well.
        symbol = before[place]
        turn = np.argsort(symbol, kind="stable")
        to, owner, symbol = moved[place[turn]], owner[turn], symbol[turn]
        cut = np.flatnonzero((symbol[1:] != symbol[:-1]) | (owner[1:] != owner[:-1]))
        new_low = to[np.concatenate([[0], cut + 1])]
        new_high = to[np.concatenate([cut, [len(to) - 1]])] + 1
        fresh = prefix[new_high] == -1
        prefix[new_high[fresh]] = length
        low, high = new_low[fresh], new_high[fresh]
        if not len(low):
            break
    return prefix[:n]


def repeated_starts(segments: list[bytes], least: int) -> list[np.ndarray]:
    """Per segment the starts of the strings of ``least`` bytes that start twice or more in all segments."""
    lengths = np.array([len(s) for s in segments], dtype=np.int64)
    parts = [p for s in segments for p in (np.frombuffer(s, dtype=np.uint8).astype(np.int16) + 1, np.zeros(1, np.int16))]
    text = np.concatenate(parts)
    order = suffix_order(text, least)
    alike = common_prefixes(text, order, least) == -1
    twice = alike.copy()
    twice[:-1] |= alike[1:]
    marked = np.zeros(len(text), dtype=bool)
    marked[order[twice]] = True
    begins = np.cumsum(lengths + 1) - lengths - 1
    # A string that would pass the end of its segment is none.
    return [np.flatnonzero(marked[b : b + max(0, n - least + 1)]) for b, n in zip(begins, lengths, strict=True)]
