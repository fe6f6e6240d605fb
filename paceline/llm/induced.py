"""External suffix sorting of a shard by recursive induced sorting, for shards larger than memory.

Only starts that share their first `length` symbols with another start are asked for, so common prefixes are counted up to
`length`, and suffixes that agree so far may stand in any order.

The left-most S suffixes (S whose predecessor is L) are sorted first: inducing from them, unsorted, sorts the substrings
between them; equal substrings get equal names; the string of names is sorted by the same procedure, down to a string that an
internal sort takes within the memory allowance. From the sorted ones all L suffixes are induced from left to right and then
all S suffixes from right to left. What a suffix induces goes into a monotone priority queue, keyed by first symbol: pushes
come in the order of the scan, so a bucket that is drained is sorted. Entries are tuples of a suffix and its common prefix
with the entry before it in its bucket: one more than the least common prefix between their inducers, a range minimum over
the scan. A bucket is taken in whole steps: those of its suffixes that stand already, then what these induce in the same
bucket (runs of one symbol, longer by one), and so on.

On disk are: the queues, beyond their allowance, as one file of runs for each, and every array with an entry for each symbol
or seed that is larger than the allowance (mapped files). A scan holds one part of a bucket at a time. What stays in memory
beyond the allowance is the bookkeeping of buckets, some 300 bytes for each distinct name of a string that is recursed into.
Files stand in the folders that Spark gives a task for its own spills and go with the task.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from pathlib import Path

import numpy as np

_CAP = np.int16


class Scratch:
    """A folder for one sort, and its memory allowance in bytes; `part` of it is what a queue or an array may hold."""

    def __init__(self, folder: Path, memory: int):
        self.folder, self.memory, self.part, self.count = folder, memory, max(64, memory // 16), 0

    def path(self) -> Path:
        self.count += 1
        return self.folder / str(self.count)

    def array(self, n: int, dtype, fill: int = 0) -> np.ndarray:
        """In memory, or a mapped file where that passes the part; a file's blocks are zeros until they are written."""
        if n * np.dtype(dtype).itemsize <= self.part:
            return np.full(n, fill, dtype)
        out = np.memmap(self.path(), dtype, "w+", shape=(n,))
        if fill:
            for lo, hi in self.ranges(n):
                out[lo:hi] = fill
        return out

    def ranges(self, n: int) -> Iterator[tuple[int, int]]:
        """Neighbouring ranges of 0 to n that are worked on at once."""
        step = max(8, self.part // 8)
        for lo in range(0, n, step):
            yield lo, min(n, lo + step)


class BucketQueue:
    """A priority queue of whole buckets: first in, first out for each symbol; `descending` gives the largest symbol first.

    Entries are (place, common prefix). Beyond the allowance what is held goes to the end of a file, a run for each symbol."""

    def __init__(self, scratch: Scratch, places: int, descending: bool = False):
        self.scratch, self.sign = scratch, -1 if descending else 1
        self.entry = np.dtype([("place", np.int32 if places < 1 << 31 else np.int64), ("common", _CAP)])
        self.held: dict[int, list[np.ndarray]] = {}
        self.runs: dict[int, list[tuple[int, int]]] = {}  # place in the file, entries
        self.order: list[int] = []
        self.size = 0
        self.file = None
        self.path: Path | None = None

    def __contains__(self, symbol: int) -> bool:
        return symbol in self.held or symbol in self.runs

    def first(self) -> int | None:
        while self.order and self.order[0] * self.sign not in self:
            heappop(self.order)
        return self.order[0] * self.sign if self.order else None

    def push(self, symbol: int, places: np.ndarray, common: np.ndarray) -> None:
        entries = np.empty(len(places), self.entry)
        entries["place"], entries["common"] = places, common
        if symbol not in self:
            heappush(self.order, symbol * self.sign)
        self.held.setdefault(symbol, []).append(entries)
        self.size += entries.nbytes
        if self.size > self.scratch.part:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.path = self.scratch.path()
            self.file = self.path.open("w+b")
        at = self.file.seek(0, os.SEEK_END)
        for symbol, entries in self.held.items():
            n = sum(map(len, entries))
            self.runs.setdefault(symbol, []).append((at, n))
            for x in entries:
                at += self.file.write(x.tobytes())
        self.held, self.size = {}, 0

    def drain(self, symbol: int, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The entries of a bucket from first to last in parts (backwards: the last part first, each in its own order). What
        is pushed to the symbol meanwhile is its next content."""
        runs, held = self.runs.pop(symbol, []), self.held.pop(symbol, [])
        self.size -= sum(x.nbytes for x in held)
        pieces: list = [*runs, *held]
        most = max(1, self.scratch.part // self.entry.itemsize)
        some: list[np.ndarray] = []
        n = 0
        for piece in reversed(pieces) if backwards else pieces:
            if isinstance(piece, tuple):
                self.file.flush()
                piece = np.frombuffer(os.pread(self.file.fileno(), piece[1] * self.entry.itemsize, piece[0]), self.entry)
            if some and n + len(piece) > most:
                yield self._joined(some, backwards)
                some, n = [], 0
            some.append(piece)
            n += len(piece)
        if some:
            yield self._joined(some, backwards)

    @staticmethod
    def _joined(some: list[np.ndarray], backwards: bool) -> tuple[np.ndarray, np.ndarray]:
        one = some[0] if len(some) == 1 else np.concatenate(some[::-1] if backwards else some)
        return one["place"].astype(np.int64), one["common"].copy()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.path.unlink()


class _RangeMinimum:
    """Minima of ranges of one array, by a table of minima over powers of two."""

    def __init__(self, values: np.ndarray, longest: int):
        self.levels = [values]
        while (1 << len(self.levels)) <= longest:
            low, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-step], low[step:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of values[lo] to values[hi], both included."""
        out = np.empty(len(lo), _CAP)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            of = level == k
            out[of] = np.minimum(self.levels[k][lo[of]], self.levels[k][hi[of] - (1 << int(k)) + 1])
        return out


class _Scan:
    """One pass over suffixes in order, which pushes the L (or S) suffixes that they induce.

    The least common prefix since a bucket's last push is a minimum over the end of the scan: of the scan so far only the
    places are kept from which on a new minimum holds, at most `length` + 1 of them."""

    def __init__(self, sorter: InducedSorter, s_wanted: bool, prefixes: bool):
        self.length, self.prefixes = sorter.length, prefixes
        n = len(sorter.text)
        self.before = sorter.scratch.array(n, sorter.text.dtype)  # the symbol before a place, where that is wanted, else -1
        self.before[0] = -1
        for lo, hi in sorter.scratch.ranges(n - 1):
            self.before[lo + 1 : hi + 1] = np.where(sorter.is_s[lo:hi] == s_wanted, sorter.text[lo:hi], -1)
        self.queue = BucketQueue(sorter.scratch, len(sorter.text), descending=s_wanted)
        self.pushed = sorter.scratch.array(sorter.symbols, np.int64, -1) if prefixes else None  # place in the scan of a bucket's last push
        self.at, self.low_at, self.low = 0, np.zeros(0, np.int64), np.zeros(0, _CAP)

    def take(self, places: np.ndarray, common: np.ndarray) -> None:
        """Scan suffixes that stand next to one another, after those scanned before."""
        symbol = self.before[places]
        at = np.flatnonzero(symbol >= 0)
        if not len(at) and not self.prefixes:
            return
        symbol = symbol[at]
        order = np.argsort(symbol, kind="stable")
        at, symbol = at[order], symbol[order]
        before = places[at] - 1
        first = np.ones(len(at), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        heads = np.flatnonzero(first)
        tails = np.append(heads[1:], len(at)) - 1
        new = self._prefixes(common, at, symbol, heads, tails, first) if self.prefixes else np.zeros(len(at), _CAP)
        for lo, hi in zip(heads.tolist(), (tails + 1).tolist() if len(heads) else [], strict=True):
            self.queue.push(int(symbol[lo]), before[lo:hi], new[lo:hi])

    def _prefixes(self, common: np.ndarray, at: np.ndarray, symbol: np.ndarray, heads: np.ndarray, tails: np.ndarray, first: np.ndarray) -> np.ndarray:
        least = np.zeros(len(at), _CAP)
        if len(at):
            last = self.pushed[symbol[heads]]
            since = np.append(self.low, _CAP(self.length))[np.searchsorted(self.low_at, last, side="right")]
            least[heads] = np.where(last < 0, _CAP(-1), np.minimum(since, np.minimum.accumulate(common)[at[heads]]))
            rest = np.flatnonzero(~first)
            if len(rest):
                lo, hi = at[rest - 1] + 1, at[rest]
                least[rest] = _RangeMinimum(common, int((hi - lo).max()) + 1)(lo, hi)
            self.pushed[symbol[tails]] = self.at + at[tails]
        to_come = np.minimum.accumulate(common[::-1])[::-1]
        points = np.flatnonzero(np.append(to_come[:-1] < to_come[1:], True))
        kept = self.low < to_come[0]
        self.low_at, self.low = np.append(self.low_at[kept], self.at + points), np.append(self.low[kept], to_come[points])
        self.at += len(common)
        return np.minimum(least + _CAP(1), _CAP(self.length))


class InducedSorter:
    """text: whole numbers below `symbols`, of which the last, and no other, is 0."""

    def __init__(self, text: np.ndarray, symbols: int, length: int, scratch: Scratch):
        self.text, self.symbols, self.length, self.scratch = text, symbols, length, scratch
        self.run, self.is_s = scratch.array(len(text), np.int32), scratch.array(len(text), bool)
        self._classify()
        of_seeds = [self._seeds_in(lo, hi) for lo, hi in scratch.ranges(len(text))]
        self.seeds = scratch.array(sum(map(len, of_seeds)), np.int64)
        at = 0
        for x in of_seeds:
            self.seeds[at : at + len(x)] = x
            at += len(x)

    def _classify(self) -> None:
        """How many equal symbols follow one another from each place, and whether its suffix is less than the next one."""
        symbol, run, is_s = -1, 0, True  # what stands behind the part: the last symbol counts as S
        for lo, hi in reversed(list(self.scratch.ranges(len(self.text)))):
            part = np.asarray(self.text[lo:hi])
            after = np.append(part[1:], symbol)
            ends = np.flatnonzero(part != after)
            rises = after[ends] > part[ends]
            if symbol == -1:
                rises[-1] = True
            counts = np.diff(np.concatenate([[-1], ends]))
            tail = hi - lo - int(counts.sum())
            runs = np.repeat(ends, counts) - np.arange(hi - lo - tail) + 1
            self.run[lo:hi] = np.append(runs, run + np.arange(tail, 0, -1))
            self.is_s[lo:hi] = np.append(np.repeat(rises, counts), np.full(tail, is_s))
            symbol, run, is_s = int(part[0]), int(self.run[lo]), bool(self.is_s[lo])

    def _seeds_in(self, lo: int, hi: int) -> np.ndarray:
        kinds = self.is_s[max(0, lo - 1) : hi]
        found = np.flatnonzero(kinds[1:] & ~kinds[:-1]) + max(0, lo - 1) + 1
        return found.astype(np.int32 if len(self.text) < 1 << 31 else np.int64)

    def _least(self, a: int, b: int) -> int:
        return min(int(self.run[a]), int(self.run[b]), self.length)

    def _induce(self, seeds: np.ndarray, common: np.ndarray | None, prefixes: bool, emit: Callable[[np.ndarray, np.ndarray], None]) -> None:
        """Seeds sorted (or, without prefixes, sorted by first symbol alone). emit(places, common) gets the S suffixes of a
        bucket from last to first, then its L suffixes from last to first; common is with the suffix handed out before."""
        waiting, left = BucketQueue(self.scratch, len(self.text)), BucketQueue(self.scratch, len(self.text), descending=True)
        for lo, hi in self.scratch.ranges(len(seeds)):
            part = np.asarray(seeds[lo:hi])
            symbol = self.text[part]
            with_before = np.zeros(hi - lo, _CAP) if common is None else np.asarray(common[lo:hi])
            cuts = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), hi - lo], strict=True):
                waiting.push(int(symbol[a]), part[a:b], with_before[a:b])

        scan = _Scan(self, False, prefixes)
        while (c := min((x for x in (scan.queue.first(), waiting.first()) if x is not None), default=None)) is not None:
            last, step = None, 0
            while c in scan.queue:
                for k, (places, with_before) in enumerate(scan.queue.drain(c)):
                    if k == 0:
                        with_before[0] = 0 if last is None else min(step, self.length)
                    left.push(c, places, with_before)
                    last = int(places[-1])
                    scan.take(places, with_before)
                step += 1
            for k, (places, with_before) in enumerate(waiting.drain(c)):
                if k == 0:
                    with_before[0] = 0 if last is None else self._least(last, int(places[0]))
                scan.take(places, with_before)
        waiting.close()
        scan.queue.close()

        scan = _Scan(self, True, prefixes)
        while (c := max((x for x in (scan.queue.first(), left.first()) if x is not None), default=None)) is not None:
            last, step = None, 0
            while c in scan.queue:
                for k, (places, with_before) in enumerate(scan.queue.drain(c)):
                    if k == 0:
                        with_before[0] = 0 if last is None else min(step, self.length)
                    emit(places, with_before)
                    last = int(places[-1])
                    scan.take(places, with_before)
                step += 1
            above = None  # common prefix of the suffix handed out last with the one before it in ascending order
            for places, ascending in left.drain(c, backwards=True):
                top = above if above is not None else 0 if last is None else self._least(last, int(places[-1]))
                with_before = np.append(_CAP(top), ascending[:0:-1]).astype(_CAP)
                above = int(ascending[0])
                emit(places[::-1], with_before)
                scan.take(places[::-1], with_before)
        end = np.array([len(self.text) - 1])
        emit(end, np.zeros(1, _CAP))
        left.close()
        scan.queue.close()

    def _named(self) -> tuple[np.ndarray, int]:
        """Names of the substrings from one seed to the next, in the order of the substrings, for the seeds from left to
        right, and how many names there are."""
        m = len(self.seeds)
        index = self.scratch.array(len(self.text), np.int32 if m < 1 << 31 else np.int64, -1)
        by_symbol = self.scratch.array(m, np.int64)
        heads = np.zeros(self.symbols + 1, np.int64)
        for lo, hi in self.scratch.ranges(m):
            part = np.asarray(self.seeds[lo:hi])
            index[part] = np.arange(lo, hi)
            heads[1:] += np.bincount(self.text[part], minlength=self.symbols)
        heads = np.cumsum(heads)
        for lo, hi in self.scratch.ranges(m):  # a counting sort by first symbol
            part = np.asarray(self.seeds[lo:hi])
            symbol = self.text[part]
            order = np.argsort(symbol, kind="stable")
            part, symbol = part[order], symbol[order]
            within = np.arange(len(part)) - np.searchsorted(symbol, symbol)
            by_symbol[heads[symbol] + within] = part
            heads[:-1] += np.bincount(symbol, minlength=self.symbols)
        order = self.scratch.array(m, np.int64)
        at = [m]

        def emit(places: np.ndarray, _) -> None:
            found = index[places]
            found = found[found >= 0][::-1]
            order[at[0] - len(found) : at[0]] = found
            at[0] -= len(found)

        self._induce(by_symbol, None, False, emit)
        assert at[0] == 0
        names = self.scratch.array(m, np.int64)
        name = 0
        last = len(self.text) - 1
        for lo, hi in self.scratch.ranges(m):
            b = np.asarray(order[lo:hi])
            a = np.append(order[lo - 1] if lo else b[0], b[:-1])
            start_a, start_b = self.seeds[a], self.seeds[b]
            sizes = np.append(self.seeds[np.minimum(b + 1, m - 1)] - start_b, 0)[:-1] + 1
            sizes_a = self.seeds[np.minimum(a + 1, m - 1)] - start_a + 1
            differs = sizes != sizes_a
            maybe, step = np.flatnonzero(~differs), 0
            while len(maybe) and step < self.length:
                maybe = maybe[sizes[maybe] > step]
                equal = self.text[np.minimum(start_a[maybe] + step, last)] == self.text[np.minimum(start_b[maybe] + step, last)]
                differs[maybe[~equal]] = True
                maybe, step = maybe[equal], step + 1
            if lo == 0:
                differs[0] = False
            found = name + np.cumsum(differs)
            names[b] = found
            name = int(found[-1])
        return names, name + 1

    def _order_of(self, names: np.ndarray, n_names: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes of the string of names in order, and how many names each shares with the one before."""
        m = len(names)
        if n_names == m:
            order = self.scratch.array(m, np.int64)
            for lo, hi in self.scratch.ranges(m):
                order[names[lo:hi]] = np.arange(lo, hi)
            return order, self.scratch.array(m, _CAP)
        enough = -(-self.length // 2)  # seeds are at least two places apart
        if m * 64 <= self.scratch.memory:
            return _sorted_in_memory(np.asarray(names), enough)
        reduced = self.scratch.array(m + 1, np.int32 if n_names < (1 << 31) - 1 else np.int64)
        for lo, hi in self.scratch.ranges(m):
            reduced[lo:hi] = names[lo:hi] + 1
        order, shared, at = self.scratch.array(m + 1, np.int64), self.scratch.array(m + 2, _CAP), [m + 1]

        def emit(places: np.ndarray, common: np.ndarray) -> None:
            lo = at[0] - len(places)
            order[lo : at[0]] = places[::-1]
            shared[lo + 1 : at[0] + 1] = common[::-1]
            at[0] = lo

        inner = InducedSorter(reduced, n_names + 1, enough, self.scratch)
        inner._induce(*inner.sorted_seeds(), True, emit)
        assert at[0] == 0 and order[0] == m
        shared[1] = 0
        return order[1:], shared[1 : m + 1]

    def sorted_seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Seeds in the order of their suffixes, with their common prefixes."""
        m = len(self.seeds)
        order, shared = self._order_of(*self._named())
        seeds, common = self.scratch.array(m, np.int64), self.scratch.array(m, _CAP)
        last = len(self.text) - 1
        for lo, hi in self.scratch.ranges(m):
            j, k = np.asarray(order[lo:hi]), np.asarray(shared[lo:hi]).astype(np.int64)
            i = np.append(order[lo - 1] if lo else j[0], j[:-1])
            x, y = self.seeds[i], self.seeds[j]
            prefix = self.seeds[np.minimum(i + k, m - 1)] - x
            alive = np.flatnonzero(prefix < self.length)
            while len(alive):
                p, q = x[alive] + prefix[alive], y[alive] + prefix[alive]
                equal = (np.maximum(p, q) <= last) & (self.text[np.minimum(p, last)] == self.text[np.minimum(q, last)])
                alive = alive[equal]
                prefix[alive] += 1
                alive = alive[prefix[alive] < self.length]
            if lo == 0:
                prefix[0] = 0
            seeds[lo:hi], common[lo:hi] = y, np.minimum(prefix, self.length)
        return seeds, common

    def repeated(self) -> np.ndarray:
        """For each place whether its first `length` symbols start at another place, too."""
        flags = self.scratch.array(len(self.text), bool)
        before: list[int] = []

        def emit(places: np.ndarray, common: np.ndarray) -> None:
            same = common >= self.length
            flags[places[same]] = True
            flags[places[np.flatnonzero(same[1:])]] = True
            if same[0] and before:
                flags[before[0]] = True
            before[:] = [int(places[-1])]

        self._induce(*self.sorted_seeds(), True, emit)
        return flags


def _sorted_in_memory(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a string in order, by doubling, and how many symbols each shares with the one before, up to `length`."""
    m = len(names)
    levels = [names]
    while levels[-1].max(initial=0) < m - 1 and (1 << (len(levels) - 1)) < length:
        rank, step = levels[-1], 1 << (len(levels) - 1)
        after = np.zeros(m, np.int64)
        after[: m - step] = rank[step:] + 1
        levels.append(np.unique(rank * (m + 2) + after, return_inverse=True)[1])
    order = np.argsort(levels[-1], kind="stable")
    i, j, shared = order[:-1].copy(), order[1:].copy(), np.zeros(max(0, m - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        equal = np.flatnonzero((np.maximum(i, j) + step < m) & (levels[k][np.minimum(i, m - 1)] == levels[k][np.minimum(j, m - 1)]))
        i[equal] += step
        j[equal] += step
        shared[equal] += step
    return order, np.append(0, np.minimum(shared, length)).astype(np.int64)


def _folder() -> str | None:
    """Where Spark lets a task spill; without it Python's choice."""
    return next((d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if d and os.path.isdir(d)), None)


class Shard:
    """Texts, written to a file one after the other, and where they repeat. Use it in a with statement."""

    def __init__(self, length: int, memory: int):
        self.length, self.folder = length, tempfile.TemporaryDirectory(prefix="paceline-suffixes-", dir=_folder())
        self.scratch = Scratch(Path(self.folder.name), memory)
        self.path = self.scratch.path()
        self.file = self.path.open("wb")
        self.sizes: list[int] = []

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()
        self.folder.cleanup()

    def add(self, text: bytes) -> int:
        """The number of the text."""
        symbols = np.ones(len(text) + 1, np.int16)  # 1 after each text, 0 at the end
        symbols[:-1] = np.frombuffer(text, np.uint8)
        symbols[:-1] += 2
        self.file.write(symbols.tobytes())
        self.sizes.append(len(text))
        return len(self.sizes) - 1

    def repeated(self) -> Iterator[np.ndarray]:
        """For each text the places where a string of `length` bytes starts, within the text, that starts anywhere else, too."""
        if not self.sizes:
            return
        self.file.write(np.zeros(1, np.int16).tobytes())
        self.file.close()
        n = sum(self.sizes) + len(self.sizes) + 1
        text = np.fromfile(self.path, np.int16) if 2 * n <= self.scratch.part else np.memmap(self.path, np.int16, "r")
        flags = InducedSorter(text, 258, self.length, self.scratch).repeated()
        lo = 0
        for size in self.sizes:
            yield np.flatnonzero(flags[lo : lo + max(0, size - self.length + 1)])
            lo += size + 1


def repeated_starts(texts: list[bytes], length: int, memory: int = 1 << 25) -> list[np.ndarray]:
    with Shard(length, memory) as shard:
        for text in texts:
            shard.add(text)
        return list(shard.repeated())
