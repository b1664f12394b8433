"""Re-Pair grammars over arrays of ids, with expansion lengths for random access.

A round counts all adjacent pairs at once and turns the frequent ones into rules, most
frequent first, as long as no symbol is the left of one rule and the right of another:
such pairs never overlap, so replacing them together equals replacing one by one.  A
pair is frequent if it occurs ``LEAST`` times.  Pairs of old symbols only get fewer, so a
round looks but at places that were frequent before or hold a new symbol.  The rounds end
when no pair is frequent.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAST = 16
SAMPLE = 1024  # symbols between two sampled positions
SLICE = 1 << 16  # places looked up at a time
MIXER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Grammar:
    """``base`` + i stands for the pair ``rules[i]``; ``lengths[i]`` ids in full."""

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def symbol_lengths(self, symbols: np.ndarray) -> np.ndarray:
        known = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        return known[symbols]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that the symbols stand for."""
        flat, starts, lengths = self._flat()
        sizes = lengths[symbols]
        ends = np.cumsum(sizes)
        if not len(ends):
            return np.zeros(0, np.uint32)
        shift = np.repeat(starts[symbols] - (ends - sizes), sizes)
        return flat[shift + np.arange(ends[-1])]

    def _flat(self):
        if not hasattr(self, "_table"):
            lengths = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
            starts = np.cumsum(lengths) - lengths
            flat = np.arange(int(lengths.sum()), dtype=np.uint32)  # a symbol below base is its id
            at, size = starts.tolist(), lengths.tolist()
            for i, (left, right) in enumerate(self.rules.tolist(), self.base):
                middle = at[i] + size[left]
                flat[at[i] : middle] = flat[at[left] : at[left] + size[left]]
                flat[middle : at[i] + size[i]] = flat[at[right] : at[right] + size[right]]
            self._table = flat, starts, lengths
        return self._table

    def positions(self) -> np.ndarray:
        """The id position before every ``SAMPLE``-th symbol."""
        before = np.cumsum(self.symbol_lengths(self.symbols)) if len(self.symbols) else []
        return np.concatenate([[0], before])[:-1:SAMPLE].astype(np.uint64)

    def between(self, start: int, end: int, positions: np.ndarray) -> np.ndarray:
        """The ids from start to end, of which only the symbols nearby are expanded."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(positions, start, "right")) - 1
        last = int(np.searchsorted(positions, end, "left"))
        ids = self.expand(self.symbols[first * SAMPLE : last * SAMPLE])
        offset = int(positions[first])
        return ids[start - offset : end - offset]


def _codes(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pairs at some places as numbers."""
    codes = np.empty(len(at), np.int64)
    for i in range(0, len(at), SLICE):
        part, places = codes[i : i + SLICE], at[i : i + SLICE]
        part[:] = symbols[places]
        part <<= 32
        part |= symbols[places + 1]
    return codes


def _frequent_pairs(ordered: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes that occur ``least`` times, ascending, and how often they do."""
    more = least - 1
    pairs, counts = [ordered[:0]], [np.zeros(0, np.int64)]
    end = max(0, len(ordered) - more)
    for i in range(0, end, SLICE):
        part = ordered[i : min(end, i + SLICE)]
        # A code that occurs n times is found n - more times.
        found = part[part == ordered[i + more : i + more + len(part)]]
        starts = _starts(found)
        pairs.append(found[starts])
        counts.append(np.diff(starts, append=len(found)))
    pairs, counts = np.concatenate(pairs), np.concatenate(counts)
    starts = _starts(pairs)  # a code may go on in the next slice
    return pairs[starts], np.add.reduceat(counts, starts) + more if len(starts) else counts


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each value begins."""
    return np.flatnonzero(np.concatenate([ordered[:1] >= 0, ordered[1:] != ordered[:-1]]))


def _places(marked: np.ndarray) -> np.ndarray:
    places = np.empty(np.count_nonzero(marked), np.int32)
    at = 0
    for i in range(0, len(marked), SLICE):
        part = np.flatnonzero(marked[i : i + SLICE])
        places[at : at + len(part)] = part + i
        at += len(part)
    return places


def _new_rules(pairs: np.ndarray, counts: np.ndarray, fresh: int) -> tuple[list, np.ndarray]:
    """Rules for pairs that can't overlap, and each pair's symbol, or 0 if it has no rule."""
    order = np.lexsort((pairs, -counts))
    rules: list[tuple[int, int]] = []
    symbol = np.zeros(len(pairs), np.int64)
    lefts: set[int] = set()
    rights: set[int] = set()
    for k, pair in zip(order.tolist(), pairs[order].tolist(), strict=True):
        a, b = pair >> 32, pair & 0xFFFFFFFF
        if a in rights or b in lefts or (a == b and (a in lefts or a in rights)):
            continue
        lefts.add(a)
        rights.add(b)
        symbol[k] = fresh + len(rules)
        rules.append((a, b))
    return rules, symbol


def _found(
    symbols: np.ndarray, at: np.ndarray, pairs: np.ndarray, symbol: np.ndarray
) -> np.ndarray:
    """The symbol of the pair at each place, or -1 where it isn't frequent.

    A table by hashes names one pair of each hash; only places of which another pair has
    the hash are searched for.
    """
    bits = len(pairs).bit_length() + 3
    table = np.full(1 << bits, -1, np.int32)
    table[_hashed(pairs, bits)] = np.arange(len(pairs), dtype=np.int32)
    found = np.empty(len(at), np.int32)
    for i in range(0, len(at), SLICE):
        part = _codes(symbols, at[i : i + SLICE])
        place = table[_hashed(part, bits)]
        right = pairs[place] == part  # a pair's own hash has a place
        found[i : i + SLICE] = np.where(right, symbol[place], -1)
        other = np.flatnonzero(~right & (place >= 0))
        place = np.minimum(np.searchsorted(pairs, part[other]), len(pairs) - 1)
        right = pairs[place] == part[other]
        found[i + other[right]] = symbol[place[right]]
    return found


def _hashed(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes.view(np.uint64) * MIXER) >> np.uint64(64 - bits)).view(np.int64)


def compress(ids: np.ndarray, base: int, least: int = LEAST) -> Grammar:
    """The grammar of the ids, all of which are below ``base``."""
    symbols = ids.astype(np.int32)
    rules: list[tuple[int, int]] = []
    unsettled = np.ones(len(symbols), bool)  # places whose pair may be frequent
    unsettled[-1:] = False
    while True:
        at = _places(unsettled)
        codes = _codes(symbols, at)
        codes.sort()
        pairs, counts = _frequent_pairs(codes, max(2, least))
        del codes
        if not len(pairs):
            break
        grown, symbol = _new_rules(pairs, counts, base + len(rules))
        rules += grown
        found = _found(symbols, at, pairs, symbol)
        unsettled[:] = False
        unsettled[at[found == 0]] = True
        replaced = _places(found > 0)
        at, found = at[replaced], found[replaced]
        # Only a pair of equal symbols can overlap itself: take every other one of a run.
        later = _places(np.diff(at, prepend=np.int32(-2)) == 1)
        if len(later):
            runs = np.flatnonzero(np.diff(later, prepend=np.int32(-2)) != 1)
            nth = np.arange(len(later)) - np.repeat(runs, np.diff(runs, append=len(later)))
            once = np.ones(len(at), bool)
            once[later[nth % 2 == 0]] = False
            at, found = at[once], found[once]
        symbols[at] = found
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, unsettled = symbols[keep], unsettled[keep]
        at -= np.arange(len(at), dtype=np.int32)  # where they are without what went
        unsettled[at] = True
        unsettled[np.maximum(at, 1) - 1] = True
        unsettled[-1] = False
    lengths = np.ones(base + len(rules), np.int64)
    for i, (a, b) in enumerate(rules):
        lengths[base + i] = lengths[a] + lengths[b]
    return Grammar(
        base,
        np.array(rules, np.uint32).reshape(-1, 2),
        lengths[base:].astype(np.uint32),
        symbols,
    )
