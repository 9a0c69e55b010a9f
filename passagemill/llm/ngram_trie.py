"""A compact n-gram trie of three levels, as arrays that can be memory-mapped.

A trie holds first words, their followers, and the words after those. Siblings lie together in the
order of their word numbers. Where a node's children begin is an Elias-Fano sequence; a child is
found by successor search among its siblings alone, that is, relative to its context. Probabilities
and back-off weights are one byte each, on a logarithmic scale between the least and the greatest of
their level.
"""

from __future__ import annotations

import numpy as np

#: Steps of the logarithmic scale; code 0 is the least value.
CODES = 256


def encode_monotone(values: np.ndarray) -> dict[str, np.ndarray]:
    """Elias-Fano code of a non-decreasing sequence: low bits as they are, high bits in unary.

    ``ones`` has the number of set bits before each 64-bit word, for selection.
    """
    values = values.astype(np.uint64)
    count = max(len(values), 1)
    top = int(values[-1]) + 1 if len(values) else 1
    low_bits = max(0, (top // count).bit_length() - 1)
    high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(len(values))
    size = (int(high[-1]) if len(high) else 0) + 1
    bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
    bits[high] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]]).astype(np.uint32)
    low = (values & np.uint64((1 << low_bits) - 1)).astype(_narrow((1 << low_bits) - 1))
    return {"words": words, "ones": ones, "low": low, "low_bits": np.array([low_bits], np.uint8)}


def _narrow(top: int) -> np.dtype:
    return np.dtype(next(kind for kind in ("u1", "u2", "u4", "u8") if top <= np.iinfo(kind).max))


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` in each word, by halving."""
    words, rank = words.copy(), rank.astype(np.uint64)
    place = np.zeros(len(words), dtype=np.uint64)
    for half in (32, 16, 8, 4, 2, 1):
        count = np.bitwise_count(words & np.uint64((1 << half) - 1)).astype(np.uint64)
        above = rank >= count
        rank -= np.where(above, count, np.uint64(0))
        step = np.where(above, np.uint64(half), np.uint64(0))
        words >>= step
        place += step
    return place.astype(np.int64)


def monotone_at(code: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Values of an Elias-Fano sequence."""
    word = np.searchsorted(code["ones"], at, side="right") - 1
    place = _select(code["words"][word], at - code["ones"][word])
    high = word * 64 + place - at
    low_bits = int(code["low_bits"][0])
    return (high << low_bits) | code["low"][at].astype(np.int64)


def encode_scale(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per positive value, and the 256 values that the bytes stand for.

    Steps are equal in the logarithm; the ends of the scale are exact.
    """
    if not len(values):
        return np.zeros(0, np.uint8), np.ones(CODES, np.float64)
    logs = np.log(values)
    low, high = float(logs.min()), float(logs.max())
    step = (high - low) / (CODES - 1)
    codes = np.rint((logs - low) / step) if step > 0 else np.zeros(len(logs))
    return codes.astype(np.uint8), np.exp(low + step * np.arange(CODES))


def _pack_numbers(values: np.ndarray, top: int) -> dict[str, np.ndarray]:
    """Word numbers in two planes, the low 16 bits and the rest in as few bytes as they need."""
    return {
        "plane_low": (values & 0xFFFF).astype(np.uint16),
        "plane_high": (values >> 16).astype(_narrow(top >> 16)) if top >> 16 else np.zeros(0, np.uint8),
    }


def _number_at(arrays: dict[str, np.ndarray], level: str, at: np.ndarray) -> np.ndarray:
    low = arrays[f"{level}.plane_low"][at].astype(np.int64)
    high = arrays[f"{level}.plane_high"]
    return low | (high[at].astype(np.int64) << 16) if len(high) else low


def discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken from n-grams seen once, twice, and more often, from how many there are of each.

    The usual estimate of modified absolute discounting, kept within bounds where it is undefined.
    """
    seen = [int((counts == times).sum()) for times in (1, 2, 3, 4)]
    if not seen[0] or not seen[1]:
        return np.array([0.0, 0.5, 0.5, 0.5])
    share = seen[0] / (seen[0] + 2 * seen[1])
    taken = [0.0]
    for times in (1, 2, 3):
        estimate = times - (times + 1) * share * seen[times] / max(seen[times - 1], 1)
        taken.append(min(max(estimate, 0.1), times - 0.05))
    return np.array(taken)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values`` that begin at ``first``; the last entry is the end."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def build_trie(
    first: np.ndarray,
    second: np.ndarray,
    counts: np.ndarray,
    first_counts: np.ndarray,
    context: np.ndarray,
    third: np.ndarray,
    third_counts: np.ndarray,
    top: int,
) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Arrays of a trie from sorted, distinct n-grams.

    ``first, second, counts`` are the pairs and ``first_counts`` how often each pair's first word
    begins any pair; ``context`` (a pair's place), ``third``, ``third_counts`` are the triples;
    ``top`` is the greatest word number. Also returns the first words and the count mass that
    discounting took from their pairs, which the caller adds up over all tries.
    """
    taken = discounts(counts)[np.minimum(counts, 3)]
    pair_values, pair_scale = encode_scale((counts - taken) / first_counts)
    starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else first[:0]
    roots = first[starts]
    root_bounds = np.append(starts, len(first)).astype(np.int64)

    third_taken = discounts(third_counts)[np.minimum(third_counts, 3)]
    triple_values, triple_scale = encode_scale((third_counts - third_taken) / np.maximum(counts[context], 1))
    children = np.searchsorted(context, np.arange(len(first) + 1)).astype(np.int64)
    left = _sums(third_taken, children) / np.maximum(counts, 1)
    weights, weight_scale = encode_scale(np.where(left > 0, left, 1.0))
    arrays = {
        "roots": roots.astype(np.uint32),
        "pairs.values": pair_values,
        "pairs.scale": pair_scale,
        "pairs.weights": weights,
        "pairs.weight_scale": weight_scale,
        "triples.values": triple_values,
        "triples.scale": triple_scale,
    }
    for level, bounds in (("roots", root_bounds), ("pairs", children)):
        arrays |= {f"{level}.begin.{key}": part for key, part in encode_monotone(bounds).items()}
    for level, numbers in (("pairs", second), ("triples", third)):
        arrays |= {f"{level}.{key}": part for key, part in _pack_numbers(numbers, top).items()}
    return arrays, roots, _sums(taken, root_bounds)


class Trie:
    """Lookups in the arrays of ``build_trie``, for many n-grams at once."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.begins = {
            level: {key: arrays[f"{level}.begin.{key}"] for key in ("words", "ones", "low", "low_bits")}
            for level in ("roots", "pairs")
        }

    def _children(self, level: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = self.begins[level]
        return monotone_at(begins, at), monotone_at(begins, at + 1)

    def _successor(self, level: str, low: np.ndarray, high: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of ``word`` among the siblings [low, high), or -1."""
        end = high.copy()
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = _number_at(self.arrays, level, middle) < word[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        found = np.full(len(word), -1, dtype=np.int64)
        inside = np.flatnonzero(low < end)
        same = inside[_number_at(self.arrays, level, low[inside]) == word[inside]]
        found[same] = low[same]
        return found

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Nodes of the pairs, -1 for those that are not there."""
        roots = self.arrays["roots"]
        found = np.full(len(first), -1, dtype=np.int64)
        if not len(roots):
            return found
        at = np.minimum(np.searchsorted(roots, first), len(roots) - 1)
        known = np.flatnonzero(roots[at] == first)
        low, high = self._children("roots", at[known])
        found[known] = self._successor("pairs", low, high, second[known])
        return found

    def triples(self, nodes: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Places of the words after the pairs' nodes, -1 for those that are not there."""
        low, high = self._children("pairs", nodes)
        return self._successor("triples", low, high, third)

    def value(self, level: str, at: np.ndarray) -> np.ndarray:
        """Discounted probabilities; 0 where there is no node."""
        codes = self.arrays[f"{level}.values"]
        found = np.zeros(len(at))
        there = np.flatnonzero(at >= 0)
        found[there] = self.arrays[f"{level}.scale"][codes[at[there]]]
        return found

    def weight(self, nodes: np.ndarray) -> np.ndarray:
        """Back-off weights of the pairs; 1 where there is no node."""
        found = np.ones(len(nodes))
        there = np.flatnonzero(nodes >= 0)
        found[there] = self.arrays["pairs.weight_scale"][self.arrays["pairs.weights"][nodes[there]]]
        return found
