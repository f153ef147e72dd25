"""Suffix sorting by induced sorting in external memory, with common-prefix values.

The order of a few suffixes (the leftmost of each run that rises to the right, below: seeds) induces that of all others:
scanning the suffixes in order, each puts the suffix one place to its left into a priority queue, under that suffix's
first symbol. One scan goes from the least symbol up, one from the greatest down. The seeds are put in order by inducing
from their bare positions, which sorts the substrings between them, by naming equal substrings alike, and by sorting the
string of the names in the same way.

What the queues hold are tuples: symbol, position, the symbols before the position (packed into 64 bits, fetched again
from the text when they are used up) and the length of the prefix that the suffix has in common with the one before it
under that symbol. That length is one more than the least such length since the symbol's last tuple came, so it is
induced along with the order. While seeds are named, seeds of one symbol count as equal without end; substrings are
equal where the induced length still is without end.

Memory: a queue keeps `memory` tuples; beyond them its largest parts go to files. Text, names, results and orders are files, read and written in blocks or mapped. Strings of names of up to `base` symbols end the recursion: they
are sorted in memory. Scans go symbol by symbol and block by block, not suffix by suffix.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

TUPLE = np.dtype([("sym", "<i8"), ("pos", "<i8"), ("before", "<u8"), ("lcp", "u1"), ("left", "u1"), ("run", "u1")], align=True)
#: A common prefix without end, and the longest counted run of a symbol.
ENDLESS, LONGEST_RUN = 255, 200
BLOCK = 1 << 16
_U = np.uint64


class Store:
    """The files of one sort, in the worker's own temporary folder, and the count of tuples in memory."""

    def __init__(self, memory: int, base: int):
        self.memory, self.base, self.held, self.spilled = memory, base, 0, 0
        self.folder = tempfile.TemporaryDirectory(prefix="induced-")
        self.live: dict[int, Fifo] = {}
        self._n = 0

    def path(self) -> str:
        self._n += 1
        return os.path.join(self.folder.name, str(self._n))

    def array(self, n: int, dtype) -> np.memmap:
        """A mapped file of n zeros."""
        return np.memmap(self.path(), dtype, "w+", shape=(max(n, 1),))

    def relieve(self) -> None:
        """Write the largest parts out until half of the memory is free."""
        if self.held > self.memory:
            for f in sorted(self.live.values(), key=lambda f: -f.size):
                if self.held <= self.memory // 2:
                    break
                f.spill()

    def close(self) -> None:
        self.folder.cleanup()


class Fifo:
    """Tuples in the order in which they came: first those in the file, then those in memory."""

    def __init__(self, store: Store):
        self.store, self.mem, self.size = store, [], 0
        self.file: str | None = None
        self.read = self.written = 0

    def append(self, x: np.ndarray) -> None:
        if not self.mem:
            self.store.live[id(self)] = self
        self.mem.append(x)
        self.size += len(x)
        self.store.held += len(x)

    def _freed(self) -> None:
        self.store.held -= self.size
        self.store.live.pop(id(self), None)
        self.mem, self.size = [], 0

    def spill(self) -> None:
        self.file = self.file or self.store.path()
        with open(self.file, "ab") as f:
            for x in self.mem:
                x.tofile(f)
        self.written += self.size
        self.store.spilled += self.size
        self._freed()

    def drain(self) -> Iterator[np.ndarray]:
        """Blocks of what is there, and of what comes meanwhile."""
        while True:
            if self.read < self.written:
                x = np.fromfile(self.file, TUPLE, min(BLOCK, self.written - self.read), offset=self.read * TUPLE.itemsize)
                self.read += len(x)
                if self.read == self.written:
                    os.unlink(self.file)
                    self.file, self.read, self.written = None, 0, 0
                yield x
            elif self.mem:
                x = self.mem[0] if len(self.mem) == 1 else np.concatenate(self.mem)
                self._freed()
                for a in range(0, len(x), BLOCK):
                    yield x[a : a + BLOCK]
            else:
                return


class Queue:
    """A priority queue of tuples by symbol, those of a symbol in the order in which they came. The symbols lo to hi are
    cut into ranges; a range is cut again when the turn comes to one of its symbols."""

    FAN = 512

    def __init__(self, lo: int, hi: int, store: Store):
        self.lo, self.width, self.store = lo, max(1, -(-(hi - lo) // self.FAN)), store
        self.parts: dict[int, Fifo | Queue] = {}

    def put(self, x: np.ndarray) -> None:
        if not len(x):
            return
        k = ((x["sym"] - self.lo) // self.width).astype(np.uint16)
        if len(x) > 1 and (k != k[0]).any():
            order = np.argsort(k, kind="stable")
            x, k = x[order], k[order]
            cut = np.flatnonzero(k[1:] != k[:-1]) + 1
            bounds = [0, *cut.tolist(), len(k)]
        else:
            bounds = [0, len(k)]
        for a, b in zip(bounds, bounds[1:]):
            part = self.parts.get(int(k[a]))
            if part is None:
                part = self.parts[int(k[a])] = Fifo(self.store)
            (part.put if isinstance(part, Queue) else part.append)(x[a:b])
        self.store.relieve()

    def size(self, symbol: int) -> int:
        """Tuples in the range of the symbol, which hasn't been taken from yet."""
        part = self.parts.get((symbol - self.lo) // self.width)
        return part.size + part.written - part.read if part else 0

    def take_range(self, symbol: int) -> np.ndarray:
        """All tuples in the range of the symbol."""
        part = self.parts.pop((symbol - self.lo) // self.width, None)
        got = list(part.drain()) if part else []
        return np.concatenate(got) if got else np.zeros(0, TUPLE)

    def take(self, symbol: int) -> Iterator[np.ndarray]:
        """All that waits under the symbol, in blocks, and what comes under it meanwhile."""
        k = (symbol - self.lo) // self.width
        if self.width == 1:
            if k not in self.parts:
                self.parts[k] = Fifo(self.store)
            yield from self.parts[k].drain()
            del self.parts[k]
            return
        part = self.parts.get(k)
        if not isinstance(part, Queue):
            whole = Queue(self.lo + k * self.width, self.lo + (k + 1) * self.width, self.store)
            for x in part.drain() if part else ():
                whole.put(x)
            part = self.parts[k] = whole
        yield from part.take(symbol)


class Text:
    """A string of numbers from 1, on file, with the packing of preceding symbols."""

    def __init__(self, a: np.ndarray, n: int, symbols: int):
        self.a, self.n, self.symbols = a, n, symbols
        self.bits = max(1, int(symbols).bit_length())
        self.many = min(8, 64 // self.bits)
        self.mask = _U((1 << self.bits) - 1)

    def before(self, pos: np.ndarray) -> np.ndarray:
        """The symbols before each position, the nearest lowest, 0 before the start."""
        out = np.zeros(len(pos), _U)
        for j in range(self.many):
            at = pos - 1 - j
            s = self.a[np.maximum(at, 0)].astype(_U)
            s[at < 0] = 0
            out |= s << _U(self.bits * j)
        return out


class Mins:
    """The least common-prefix length since each symbol's last tuple."""

    def __init__(self, text: Text, store: Store, cap: int):
        make = (lambda n, t: np.zeros(n, t)) if text.symbols < 1 << 20 else store.array
        self.tail, self.at = make(text.symbols + 2, np.uint8), make(text.symbols + 2, np.int64)
        self.now, self.cap = 1, cap
        self.times: list[int] = []
        self.values: list[int] = []

    def insert(self, l: np.ndarray, idx: np.ndarray, d: np.ndarray) -> np.ndarray:
        """l: lengths of a block of suffixes in order; idx: those that put a tuple under the symbols d. The tuples'
        lengths. A symbol's first tuple has none in common with what stands before it."""
        out = np.zeros(len(idx), np.uint8)
        if len(idx):
            order = np.argsort(d.astype(np.uint16) if len(self.at) < 1 << 16 else d, kind="stable")
            ds, at = d[order], idx[order]
            first = np.ones(len(ds), bool)
            first[1:] = ds[1:] != ds[:-1]
            res = np.empty(len(ds), np.uint8)
            ahead = np.minimum.accumulate(l)
            f = np.flatnonzero(first)
            sym = ds[f]
            last = self.at[sym]
            known = np.minimum(self.tail[sym], ahead[at[f]])
            if self.times:
                i = np.searchsorted(self.times, last, "right")
                known = np.minimum(known, np.append(np.array(self.values, np.uint8), ENDLESS)[i])
            o = np.flatnonzero(~first)
            if len(o):
                res[o] = self._range_min(l, at[o - 1] + 1, at[o])
            res[f] = known
            res = np.where(res == ENDLESS, ENDLESS, np.minimum(res.astype(np.int64) + 1, self.cap)).astype(np.uint8)
            res[f[last == 0]] = 0
            out[order] = res
            e = np.append(f[1:], len(ds)) - 1
            behind = np.append(np.minimum.accumulate(l[::-1])[::-1], ENDLESS).astype(np.uint8)
            self.tail[sym], self.at[sym] = behind[at[e] + 1], self.now
        if len(l):
            low = int(l.min())
            while self.values and self.values[-1] >= low:
                self.times.pop()
                self.values.pop()
            self.times.append(self.now)
            self.values.append(low)
        self.now += 1
        return out

    @staticmethod
    def _range_min(l: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least of l[a..b]."""
        level = np.frexp(b - a + 1)[1] - 1
        tables = [l]
        for k in range(int(level.max())):
            t = tables[-1]
            tables.append(np.minimum(t[: -(1 << k)], t[1 << k :]))
        if len(tables) == 1:
            return l[a]
        out = np.empty(len(a), np.uint8)
        for k in np.unique(level).tolist():
            i = level == k
            out[i] = np.minimum(tables[k][a[i]], tables[k][b[i] - (1 << k) + 1])
        return out


def _tuples(text: Text, pos: np.ndarray, lcp=ENDLESS, run=1) -> np.ndarray:
    x = np.empty(len(pos), TUPLE)
    x["sym"], x["pos"], x["before"], x["left"], x["lcp"], x["run"] = text.a[pos], pos, text.before(pos), text.many, lcp, run
    return x


def _seeds(text: Text) -> Iterator[np.ndarray]:
    """Positions of the leftmost S suffixes, from the right end, in descending blocks. A suffix is of type S if it is less
    than the next one; a run of one symbol is of the type of its last place, the last suffix of type L."""
    next_symbol, next_s, held = 0, False, None
    for hi in range(text.n, 0, -BLOCK):
        lo = max(0, hi - BLOCK)
        a = np.append(text.a[lo:hi], next_symbol).astype(np.int64)
        edge = np.flatnonzero(a[1:] != a[:-1])
        s = np.full(len(a) - 1, next_s)
        if len(edge):
            where = np.searchsorted(edge, np.arange(len(a) - 1))
            in_ = where < len(edge)
            s[in_] = (a[edge] < a[edge + 1])[where[in_]]
        if held is not None and not s[-1] and next_s:
            yield np.array([hi])
        pos = np.flatnonzero(s[1:] & ~s[:-1]) + 1 + lo
        if len(pos):
            yield pos[::-1]
        next_symbol, next_s, held = int(a[0]), bool(s[0]), True


def _induce(text: Text, seeds: Iterator[np.ndarray], counts: np.ndarray, store: Store, cap: int, naming: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefix with the one before), in descending order: of all suffixes, or with naming of the seeds
    alone. seeds: tuples by ascending symbol; counts: how many there are in each range of symbols.

    Few symbols are taken one by one, many in ranges: of a range's tuples in order, those up to the least symbol of the
    range under which one of them will put another go at once. A range that memory doesn't hold is taken by symbols."""

    def left(x: np.ndarray, l: np.ndarray, ok: np.ndarray, d: np.ndarray, same: np.ndarray | bool) -> np.ndarray:
        """Tuples of what stands left of the suffixes x that are ok; d: the symbols there; same: which equal x's own."""
        i = np.flatnonzero(ok)
        new = x[i]
        d = d[i]
        new["run"] = np.where(same[i], np.minimum(new["run"], LONGEST_RUN - 1) + 1, 1)
        new["sym"], new["lcp"] = d, mins.insert(l, i, d)
        new["pos"] -= 1
        new["before"] >>= _U(text.bits)
        new["left"] -= 1
        if (out := new["left"] == 0).any():
            out = np.flatnonzero(out)
            new["before"][out], new["left"][out] = text.before(new["pos"][out]), text.many
        return new

    def ahead(x: np.ndarray) -> np.ndarray:
        return (x["before"] & text.mask).astype(np.int64)

    top = text.symbols + 1
    path, n = store.path(), 0
    waiting = next(seeds, None)

    def seeds_to(c: int) -> Iterator[np.ndarray]:
        """Blocks of the seeds of symbols up to c."""
        nonlocal waiting
        while waiting is not None:
            k = int(np.searchsorted(waiting["sym"], c, "right"))
            x, rest = waiting[:k], waiting[k:]
            waiting = rest if len(rest) else next(seeds, None)
            if k:
                yield x
            if len(rest):
                return

    def up(c: int) -> None:
        nonlocal n
        run, some = 0, False
        for x in queue.take(c):
            d = ahead(x)
            queue.put(left(x, x["lcp"], d >= c, d, d == c))
            x.tofile(results)
            n, run, some = n + len(x), int(x["run"][-1]), True
        first = True
        for x in seeds_to(c):
            l = x["lcp"].copy()
            if first:
                l[0] = min(run, int(x["run"][0]), cap) if some else 0
                first = False
            d = ahead(x)
            queue.put(left(x, l, d > c, d, d == c))

    def up_range(a: int, b: int) -> None:
        nonlocal n
        x = queue.take_range(a)
        s = [q.copy() for q in seeds_to(b - 1)]
        s = np.concatenate(s) if s else np.zeros(0, TUPLE)
        if len(s):
            s["lcp"][np.append(True, s["sym"][1:] != s["sym"][:-1])] = 0
        key = np.concatenate((2 * x["sym"], 2 * s["sym"] + 1))
        x = np.concatenate((x, s))
        order = np.argsort(key, kind="stable")
        x, key = x[order], key[order]
        while len(x):
            d = ahead(x)
            ok = d >= x["sym"] + (key & 1)
            here = d[ok & (d < b)]
            k = int(np.searchsorted(key, 2 * int(here.min()), "right")) if len(here) else len(x)
            done, x = x[:k], x[k:]
            lows = done[key[:k] & 1 == 0]
            lows.tofile(results)
            n += len(lows)
            new = left(done, done["lcp"], ok[:k], d[:k], d[:k] == done["sym"])
            key = key[k:]
            near = new["sym"] < b
            queue.put(new[~near])
            if near.any():
                new = new[near]
                new = new[np.argsort(new["sym"], kind="stable")]
                at = np.searchsorted(key, 2 * new["sym"], "right")
                x, key = np.insert(x, at, new), np.insert(key, at, 2 * new["sym"])

    since = ENDLESS  # the least length since the last seed that was named

    def named(x: np.ndarray, l: np.ndarray, is_seed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nonlocal since
        i = np.flatnonzero(is_seed)
        if len(i):
            low = np.minimum.reduceat(l[: i[-1] + 1], np.append(0, i[:-1] + 1))
            low[0] = min(since, int(low[0]))
            yield x["pos"][i], low
            since = ENDLESS
        rest = l[(i[-1] + 1 if len(i) else 0) :]
        if len(rest):
            since = min(since, int(rest.min()))

    def down(c: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nonlocal n
        run, some = 0, False
        for x in queue.take(c):
            d = ahead(x)
            queue.put(left(x, x["lcp"], (d <= c) & (d > 0), d, d == c))
            run, some = int(x["run"][-1]), True
            yield from named(x, x["lcp"], d > c) if naming else ((x["pos"], x["lcp"]),)
        first, behind = True, 0
        while n and int(file["sym"][n - 1]) == c:
            x = np.array(file[max(0, n - BLOCK) : n])
            x = x[np.searchsorted(x["sym"], c) :][::-1].copy()
            n -= len(x)
            # the length with the greater one before it is the one that this has with its less one
            l = np.append(behind, x["lcp"][:-1]).astype(np.uint8)
            behind = int(x["lcp"][-1])
            if first:
                l[0] = min(run, int(x["run"][0]), cap) if some else 0
                first = False
            d = ahead(x)
            queue.put(left(x, l, (d < c) & (d > 0), d, d == c))
            yield from named(x, l, np.zeros(len(x), bool)) if naming else ((x["pos"], l),)

    def down_range(a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nonlocal n
        x = queue.take_range(a)
        lo = n
        while lo and int(file["sym"][lo - 1]) >= a:
            lo = max(0, lo - BLOCK)
        s = np.array(file[lo:n])
        s = s[np.searchsorted(s["sym"], a) :][::-1].copy()
        n -= len(s)
        if len(s):
            s["lcp"] = np.append(0, s["lcp"][:-1])
        key = np.concatenate((-2 * x["sym"], -2 * s["sym"] + 1))
        x = np.concatenate((x, s))
        order = np.argsort(key, kind="stable")
        x, key = x[order], key[order]
        while len(x):
            d = ahead(x)
            ok = (d > 0) & (d <= x["sym"] - (key & 1))
            here = d[ok & (d >= a)]
            k = int(np.searchsorted(key, -2 * int(here.max()), "right")) if len(here) else len(x)
            done, x, d, ok = x[:k], x[k:], d[:k], ok[:k]
            new = left(done, done["lcp"], ok, d, d == done["sym"])
            is_seed = (key[:k] & 1 == 0) & (d > done["sym"])
            key = key[k:]
            near = new["sym"] >= a
            queue.put(new[~near])
            if near.any():
                new = new[near]
                new = new[np.argsort(-new["sym"], kind="stable")]
                at = np.searchsorted(key, -2 * new["sym"], "right")
                x, key = np.insert(x, at, new), np.insert(key, at, -2 * new["sym"])
            yield from named(done, done["lcp"], is_seed) if naming else ((done["pos"], done["lcp"]),)

    queue, mins = Queue(0, top + 1, store), Mins(text, store, cap)
    end = np.zeros(1, TUPLE)
    end["pos"], end["before"], end["left"] = text.n, text.before(np.array([text.n])), text.many
    d = ahead(end)
    queue.put(left(end, end["lcp"], d > 0, d, d == 0))
    wide = queue.width > 1 and cap <= 1  # ranges carry no runs: only whether a length has an end counts
    ranges = [(a, min(a + queue.width, top)) for a in range(0, top, queue.width)]
    begin = []
    with open(path, "wb") as results:
        for k, (a, b) in enumerate(ranges):
            begin.append(n)
            if wide and queue.size(a) + counts[k] <= store.memory:
                up_range(a, b)
            else:
                for c in range(max(a, 1), b):
                    up(c)
    queue, mins = Queue(0, top + 1, store), Mins(text, store, cap)
    file = np.memmap(path, TUPLE, "r", shape=(n,)) if n else np.zeros(0, TUPLE)
    for (a, b), start in zip(reversed(ranges), reversed(begin)):
        if wide and queue.size(a) + n - start <= store.memory:
            yield from down_range(a, b)
        else:
            for c in range(b - 1, max(a, 1) - 1, -1):
                yield from down(c)
    del file
    os.unlink(path)


def _doubling(t: np.ndarray) -> np.ndarray:
    """Suffix order by sorting on doubled prefixes: the end of the recursion."""
    _, rank = np.unique(t, return_inverse=True)
    n, k = len(t), 1
    order = np.argsort(rank, kind="stable")
    while n and rank[order[-1]] < n - 1:
        nxt = np.zeros(n, np.int64)
        nxt[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + nxt
        order = np.argsort(key)
        step = np.concatenate(([0], key[order][1:] != key[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        k *= 2
    return order


def _common(text: Text, p: np.ndarray, q: np.ndarray, cap: int) -> np.ndarray:
    """The length of the common prefix of the suffixes at p and q, up to cap. The text is followed by zeros."""
    out = np.full(len(p), cap, np.uint8)
    i, step = np.arange(len(p)), 4
    a = 0
    while a < cap and len(i):
        b = min(cap, a + step)
        j = np.arange(a, b)
        diff = text.a[p[i, None] + j] != text.a[q[i, None] + j]
        some = diff.any(1)
        out[i[some]] = a + diff[some].argmax(1)
        i, a, step = i[~some], b, 2 * step
    return out


def suffixes(text: Text, store: Store, cap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (positions, common prefix with the suffix before, up to cap), in descending order of the suffixes. Common
    prefixes count only with a cap of 1 or more; text.a goes on for cap places beyond the text's end, all 0."""
    raw = Queue(0, text.symbols + 2, store)
    n, counts = 0, np.zeros(Queue.FAN + 1, np.int64)
    for pos in _seeds(text):
        raw.put(_tuples(text, pos))
        n += len(pos)
        counts += np.bincount(text.a[pos] // raw.width, minlength=len(counts))
    bare = (x for c in range(1, text.symbols + 1) for x in raw.take(c))
    if n <= 1:
        one = list(bare)
        for x in one:
            x["lcp"], x["run"] = 0, 1 + _common(text, x["pos"], x["pos"] + 1, min(cap, LONGEST_RUN - 1))
        yield from _induce(text, iter(one), counts, store, max(cap, 1), False)
        return
    # names, from the greatest down: 0, 1, ...; two seeds are two places apart at least
    by_place = store.array(text.n // 2 + 1, np.int64)
    name = -1
    for pos, l in _induce(text, bare, counts, store, 1, True):
        names = name + np.cumsum(l != ENDLESS)
        if name < 0:
            names += l[0] == ENDLESS
        name = int(names[-1])
        by_place[pos >> 1] = names + 1
    places, reduced = store.array(n, np.int64), store.array(n, np.int64)
    at = 0
    for seed in _ascending(text):
        places[at : at + len(seed)] = seed
        reduced[at : at + len(seed)] = name + 2 - by_place[seed >> 1]
        at += len(seed)
    del by_place
    order = store.array(n, np.int64)  # of the seeds, ascending
    if name + 1 == n:
        for a in range(0, n, BLOCK):
            order[reduced[a : a + BLOCK] - 1] = places[a : a + BLOCK]
    elif n <= store.base:
        order[:] = places[_doubling(np.array(reduced))]
    else:
        at = n
        for pos, _ in suffixes(Text(reduced, n, name + 1), store, 0):
            order[at - len(pos) : at] = places[pos][::-1]
            at -= len(pos)
    del places, reduced

    def ordered() -> Iterator[np.ndarray]:
        for a in range(0, n, BLOCK):
            pos = np.array(order[a : a + BLOCK])
            x = _tuples(text, pos, 0)
            if cap:
                x["lcp"] = _common(text, pos, np.append(order[a - 1] if a else pos[0], pos[:-1]), cap)
                x["run"] = 1 + _common(text, pos, pos + 1, min(cap, LONGEST_RUN - 1))
            yield x

    yield from _induce(text, ordered(), counts, store, max(cap, 1), False)


def _ascending(text: Text) -> Iterator[np.ndarray]:
    """The seeds in ascending blocks: the text is scanned by stretches, each from its right end."""
    stretch = BLOCK * 16
    if text.n <= stretch:
        got = [x for x in _seeds(text)]
        if got:
            yield np.concatenate(got)[::-1]
        return
    for lo in range(0, text.n, stretch):
        hi = min(text.n, lo + stretch)
        # a stretch goes on to where the symbols differ: there the type is known
        end = hi
        while end < text.n and text.a[end] == text.a[end - 1]:
            end += 1
        part = Text(np.append(text.a[max(0, lo - 1) : min(text.n, end + 1)], 0), min(text.n, end + 1) - max(0, lo - 1), text.symbols)
        got = [x for x in _seeds(part)]
        if got:
            pos = np.concatenate(got)[::-1] + max(0, lo - 1)
            pos = pos[(pos >= lo) & (pos < hi)]
            if len(pos):
                yield pos


def as_text(a: np.ndarray, store: Store, cap: int = 0) -> Text:
    """An array of numbers from 0 as a text on file."""
    t = store.array(len(a) + cap + 1, np.int64)
    t[: len(a)] = np.asarray(a, np.int64) + 1
    return Text(t, len(a), int(a.max()) + 1 if len(a) else 1)


def suffix_order(a: np.ndarray, memory: int = 1_000_000, base: int = 1_000_000, cap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a in ascending order of their suffixes, and the common prefix, up to cap, of each with the one before
    it. All in memory: for tests."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    store = Store(memory, base)
    try:
        got = [(np.array(p), np.array(l)) for p, l in suffixes(as_text(a, store, cap), store, cap)]
    finally:
        store.close()
    pos, l = np.concatenate([p for p, _ in got])[::-1], np.concatenate([x for _, x in got])
    return pos, np.append(0, l[1:][::-1]).astype(np.uint8)
