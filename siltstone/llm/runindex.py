"""A run-length index of many short texts: run-compressed Burrows-Wheeler transform with sampled run ends.

Suffixes of all texts are sorted together; a text's end is a symbol of its own, smaller than any byte, and earlier texts' ends are
smaller. Only what grows with the number of runs is kept: each run's symbol, start and the text positions at its head and end, and for
each place where the lexicographic neighbour changes its course the neighbour and the length of the match with it.

Between two such samples both are linear: if suffix i + 1 does not head a run, the neighbour of suffix i is one left of i + 1's
and their match is one longer. So matching statistics of the whole collection against itself are streamed
from the samples, in time linear in the text, without the suffix array.
"""

from __future__ import annotations

import numpy as np


def _ordered(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of keys of so many bits, and the keys in it. With room left for the positions, plain sorting of both in one word is
    several times faster than sorting positions by key."""
    place = max(1, int(len(key) - 1).bit_length())
    if bits + place > 64:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    packed = np.sort(key << np.uint64(place) | np.arange(len(key), dtype=np.uint64))
    return (packed & np.uint64((1 << place) - 1)).astype(np.int64), packed >> np.uint64(place)


class _Suffixes:
    """Suffix array by prefix doubling, with what tells how much two suffixes share: ``first``, each position's first ``span`` symbols in a
    word, and ``ranks``, (span, rank of each position by its first span symbols) of each round.

    symbols: byte + 1; end: where each position's text ends; reach: longest text. The first sort takes as many symbols as fit in a word
    beside the position, with as many bits a symbol as the symbols that occur need. Later rounds sort only what is still tied.
    """

    def __init__(self, symbols: np.ndarray, end: np.ndarray, reach: int):
        n = len(symbols)
        code = np.cumsum(np.bincount(symbols, minlength=258) > 0).astype(np.uint64)  # 0: past the end
        self.width, half = int(code[-1]).bit_length(), np.uint64(int(n).bit_length())
        room = min(64 - max(1, int(n - 1).bit_length()), 53)  # doubles hold 53 bits, see shared()
        self.span = span = max(1, room // self.width)
        left = end - np.arange(n)
        padded = np.concatenate((code[symbols], np.zeros(span, np.uint64)))
        key = np.zeros(n, np.uint64)
        for i in range(span):
            key <<= np.uint64(self.width)
            key |= padded[i : n + i]
        short = np.flatnonzero(left < span)  # the next text's symbols go
        past = ((span - left[short]) * self.width).astype(np.uint64)
        key[short] = key[short] >> past << past
        self.first, self.ranks = key, []
        order, ordered = _ordered(key, span * self.width)
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        rows, at, begins, rank = np.arange(n), order, new, np.empty(n, np.uint32)
        while True:
            # a position's rank is the row where its group begins
            rank[at] = np.maximum.accumulate(np.where(begins, rows, 0))
            self.ranks.append((span, rank))
            rows = np.flatnonzero(~(new & np.concatenate((new[1:], [True]))))
            if span >= reach or not len(rows):
                break  # equal suffixes end with their texts and stay in text order, as their end symbols do
            at = order[rows]
            later = np.where(left[at] > span, rank[np.minimum(at + span, n - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0))
            again, ordered = _ordered(rank[at].astype(np.uint64) << half | later, 2 * int(half))
            at = at[again]
            begins = np.concatenate(([True], ordered[1:] != ordered[:-1]))
            order[rows], new[rows], rank, span = at, begins, rank.copy(), span * 2
        self.order = order

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length that suffixes share in their first span symbols."""
        differ = np.frexp((self.first[a] ^ self.first[b]).astype(np.float64))[1]  # bits from the first that differs on
        return (self.span * self.width - differ) // self.width


class RunIndex:
    def __init__(self, texts: list[bytes]):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.n, self.text_end = len(data), np.cumsum(size)
        n = self.n
        if not n:
            self.run_symbol = self.run_start = self.head = self.tail = self.at = self.neighbour = self.match = np.zeros(0, np.int64)
            return
        symbols = data.astype(np.uint16) + 1
        end = np.repeat(self.text_end, size)
        starts = np.repeat(self.text_end - size, size)
        suffixes = _Suffixes(symbols, end, int(size.max()))
        order = suffixes.order
        before = np.where(order > starts[order], symbols[order - 1], 0).astype(np.int64)
        # every text start has an end symbol of its own before it, so it is a run of its own
        heads = np.concatenate(([True], (before[1:] != before[:-1]) | (before[1:] == 0)))
        self.run_start = np.flatnonzero(heads)
        self.run_symbol = before[self.run_start]
        self.head = order[self.run_start]
        self.tail = order[np.concatenate((self.run_start[1:], [n])) - 1]
        self.count_before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=258))))
        # the rows of the end symbols are not stored: each is preceded by its text's last byte
        self.last = np.bincount(symbols[self.text_end[size > 0] - 1], minlength=258)
        # the neighbour's course changes just before each run head's position, and at each text's last byte
        previous = self.head - 1
        sampled = np.zeros(n, bool)
        sampled[previous[self.run_symbol > 0]] = sampled[self.text_end[size > 0] - 1] = True
        self.at = np.flatnonzero(sampled)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        row = rank[self.at]
        self.neighbour = np.where(row > 0, order[row - 1], -1)
        self.match = _common(suffixes, self.at, self.neighbour, end)

    @property
    def runs(self) -> int:
        return len(self.run_start)

    def _rank(self, symbol: int, row: int) -> int:
        """Occurrences of the symbol in the transform's first rows."""
        same = np.flatnonzero(self.run_symbol == symbol)
        starts = self.run_start[same]
        stops = np.concatenate((self.run_start[1:], [self.n]))[same]
        return int(np.clip(np.minimum(stops, row) - starts, 0, None).sum())

    def count(self, pattern: bytes) -> int:
        """Occurrences of a pattern, by backward search over the runs."""
        low, high = 0, self.n
        if not self.n:
            return 0
        for place, byte in enumerate(reversed(pattern)):
            symbol = byte + 1
            start, ends = int(self.count_before[symbol]), int(self.last[symbol])
            low, high = start + self._rank(symbol, low) + (ends if place else 0), start + self._rank(symbol, high) + ends
            if low >= high:
                return 0
        return high - low

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position: the position of its suffix's lexicographic predecessor (-1: none) and the length they share."""
        reach = np.diff(np.concatenate(([-1], self.at)))
        back = np.repeat(self.at, reach) - np.arange(self.n)
        neighbour, match = np.repeat(self.neighbour, reach), np.repeat(self.match, reach)
        return np.where(neighbour >= 0, neighbour - back, -1), np.where(neighbour >= 0, match + back, 0)

    def first_occurrence(self, length: int) -> np.ndarray:
        """For every position the smallest position where the same ``length`` bytes start within one text; a position with
        fewer bytes left, or the only one of its bytes, is its own."""
        neighbour, match = self.statistics()
        first = np.arange(self.n)
        long = np.flatnonzero(match >= length)
        if not len(long):
            return first
        # positions of the same bytes are neighbours of one another in a chain: follow each chain to its head
        chained = np.zeros(self.n, bool)
        chained[long] = chained[neighbour[long]] = True
        member = np.flatnonzero(chained)
        place = np.cumsum(chained) - 1
        to = np.arange(len(member))
        to[place[long]] = place[neighbour[long]]
        while True:
            further = to[to]
            if np.array_equal(further, to):
                break
            to = further
        least = member.copy()
        np.minimum.at(least, to, member)
        first[member] = least[to]
        return first


def _common(suffixes: _Suffixes, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length that the suffixes at a and b share within their texts (b -1: none). Most differ in their first symbols; the others
    are compared by the ranks from the widest on."""
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(b >= 0)
    x, y = a[live], b[live]
    limit = np.minimum(end[x] - x, end[y] - y)
    share = np.minimum(suffixes.shared(x, y), limit)
    left = np.flatnonzero((share == suffixes.span) & (share < limit))
    for span, rank in reversed(suffixes.ranks):
        same = left[rank[x[left] + share[left]] == rank[y[left] + share[left]]]
        share[same] = np.minimum(share[same] + span, limit[same])
        left = left[share[left] < limit[left]]
    while len(left):
        more = suffixes.shared(x[left] + share[left], y[left] + share[left])
        share[left] = np.minimum(share[left] + more, limit[left])
        left = left[(more == suffixes.span) & (share[left] < limit[left])]
    out[live] = share
    return out
