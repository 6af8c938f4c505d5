"""External induced sorting: suffix order and common prefixes of a shard's text.

The text is a sequence of small symbols.  A suffix is of type S if it is smaller
than the one after it, else of type L; an S after an L is a star.  The stars'
order comes from a shorter text, whose symbols are the ranks of the pieces between
stars, by recursion.  From the stars all L suffixes are induced in ascending
order, from these all S suffixes in descending order: a suffix that leaves its
queue puts the one before it, as a tuple of position and common prefix, into the
queue of that one's first symbol.  Tuples come out of each queue in the order they
went in, so the queues of all symbols are one priority queue with a cheap order.

The common prefix of two suffixes that enter a queue one after the other is one
more than that of the suffixes they were induced from: the least value between
them, if they share their first symbol, else zero.  Values are capped.

Queues keep their newest tuples in memory and the rest in files, and are read
block by block, so a shard may be far larger than memory; the text itself may be
a mapped file.  Short texts are ordered by doubling in memory.
"""

import os
import tempfile

import numpy as np

BLOCK = 1 << 18  # tuples handled at once
IN_MEMORY = 1 << 21  # tuples that all queues of a phase keep in memory
DIRECT = 1 << 21  # texts of up to so many symbols are ordered by doubling


class Queues:
    """First-in first-out queues of (position, common prefix), one for each symbol, that spill to one folder."""

    def __init__(self, symbols: int, folder: str, in_memory: int):
        self.parts: dict[int, list] = {}
        self.folder, self.in_memory, self.held, self.files = folder, in_memory, 0, 0
        self.symbols = symbols

    def push(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        if len(at):
            self.parts.setdefault(symbol, []).append((at, lcp))
            self.held += len(at)
            if self.held > self.in_memory:
                self.spill()

    def spill(self) -> None:
        """All tuples in memory go to one file; the queues keep where theirs lie."""
        name = os.path.join(self.folder, f"{id(self)}-{self.files}")
        self.files += 1
        place = 0
        with open(name, "wb") as out:
            for symbol, parts in self.parts.items():
                kept = []
                for part in parts:
                    if isinstance(part[0], str):
                        kept.append(part)
                        continue
                    at, lcp = part
                    out.write(np.ascontiguousarray(at, np.int64).tobytes())
                    out.write(np.ascontiguousarray(lcp, np.uint16).tobytes())
                    kept.append((name, place, len(at)))
                    place += 10 * len(at)
                self.parts[symbol] = kept
        self.held = 0

    @staticmethod
    def load(part) -> tuple[np.ndarray, np.ndarray]:
        if not isinstance(part[0], str):
            return part
        name, place, n = part
        with open(name, "rb") as f:
            f.seek(place)
            return np.frombuffer(f.read(8 * n), np.int64), np.frombuffer(f.read(2 * n), np.uint16)

    def pop(self, symbol: int):
        """Blocks in the order they came, those pushed meanwhile included."""
        i = 0
        while i < len(parts := self.parts.get(symbol, ())):
            at, lcp, i = [], [], i
            while i < len(parts := self.parts[symbol]) and sum(map(len, at)) < BLOCK:
                a, v = self.load(parts[i])
                if not isinstance(parts[i][0], str):
                    self.held -= len(a)
                parts[i] = (np.empty(0, np.int64), np.empty(0, np.uint16))
                at.append(a)
                lcp.append(v)
                i += 1
            yield np.concatenate(at), np.concatenate(lcp)
        self.parts.pop(symbol, None)

    def backwards(self, symbol: int):
        """Parts from the newest to the oldest, each turned round, with the common prefix to the next larger one."""
        parts = self.parts.pop(symbol, [])
        after = None  # the value of the part's successor
        for part in reversed(parts):
            at, lcp = self.load(part)
            if not isinstance(part[0], str):
                self.held -= len(at)
            turned = np.empty(len(lcp), np.uint16)
            turned[1:] = lcp[:0:-1]
            yield at[::-1], turned, after
            after = int(lcp[0])


class Least:
    """Least value of any range of an array: two overlapping powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - width], last[width:]))
            width *= 2

    def between(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least of values[lo..hi], both included."""
        out = np.empty(len(lo), np.uint16)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            table = self.levels[k]
            out[own] = np.minimum(table[lo[own]], table[hi[own] - (1 << int(k)) + 1])
        return out


class Source:
    """One bucket of sources: keeps, for each symbol, the least value since the last suffix sent there."""

    def __init__(self, symbols: int, cap: int, queues: Queues):
        self.cap, self.queues = cap, queues
        self.symbols = symbols
        self.since: np.ndarray | None = None  # made only for buckets of more than one block

    def send(self, at: np.ndarray, lcp: np.ndarray, symbol: np.ndarray, goes: np.ndarray, last_block: bool) -> None:
        """Induces the suffix before each one that goes; `lcp` is that of neighbours in this bucket."""
        index = np.flatnonzero(goes)
        to = symbol[index]
        order = np.argsort(to, kind="stable")
        index, to = index[order], to[order]
        values = np.zeros(len(index), np.uint16)
        if len(index):
            same = np.zeros(len(index), bool)
            same[1:] = to[1:] == to[:-1]
            least = Least(lcp)
            inner = np.flatnonzero(same)
            values[inner] = least.between(index[inner - 1] + 1, index[inner])
            heads = np.flatnonzero(~same)
            if self.since is not None:
                upto = np.minimum.accumulate(lcp)
                values[heads] = np.minimum(upto[index[heads]], self.since[to[heads]])
            # else nothing of this bucket went there before: the neighbours differ after their first symbol
            bounds = np.append(heads, len(index))
            sent = np.minimum(values.astype(np.int32) + 1, self.cap).astype(np.uint16)
            for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                self.queues.push(int(to[a]), at[index[a:b]] - 1, sent[a:b])
        if not last_block or self.since is not None:
            if self.since is None:
                self.since = np.zeros(self.symbols, np.uint16)
            self.since = np.minimum(self.since, lcp.min() if len(lcp) else self.cap).astype(np.uint16)
            if len(index):
                tails = np.append(heads[1:], len(index)) - 1
                after = np.full(len(lcp) + 1, self.cap, np.uint16)
                after[:-1] = np.minimum.accumulate(lcp[::-1])[::-1]
                self.since[to[tails]] = after[index[tails] + 1]


def types(text: np.ndarray) -> np.ndarray:
    """True for S.  The end counts as larger than any symbol."""
    n = len(text)
    out = np.ones(n, bool)
    if n > 1:
        differs = np.flatnonzero(text[:-1] != text[1:])
        smaller = text[:-1][differs] < text[1:][differs]
        if len(differs):
            where = np.searchsorted(differs, np.arange(n - 1))
            inside = where < len(differs)
            out[:-1][inside] = smaller[where[inside]]
    return out


def runs_of(text: np.ndarray, at: int, cap: int) -> int:
    """How often the symbol at a place follows itself, up to `cap`."""
    part = np.asarray(text[at : at + cap])
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def piece_ranks(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of smaller pieces text[start..end] for each; a piece that goes on beyond another is the smaller one."""
    small = text.dtype == np.uint8
    per_lane, stop = (8, 0xFF) if small else (2, 0xFFFFFFFF)
    bits = 64 // per_lane
    size = ends - starts + 1
    rank = np.zeros(len(starts), np.int64)
    active, lane = np.arange(len(starts)), 0
    while len(active):
        left = size[active] - per_lane * lane
        key = np.zeros(len(active), np.uint64)
        for j in range(per_lane):
            place = np.minimum(starts[active] + per_lane * lane + j, len(text) - 1)
            value = np.where(j < left, text[place], np.where(j == left, stop, 0)).astype(np.uint64)
            key |= value << np.uint64(64 - bits * (j + 1))
        order = np.lexsort((key, rank[active])) if lane else np.argsort(key, kind="stable")
        key, base = key[order], rank[active][order]
        group = np.ones(len(order), bool)
        group[1:] = base[1:] != base[:-1]
        new = group.copy()
        new[1:] |= key[1:] != key[:-1]
        first_of_group = np.maximum.accumulate(np.where(group, np.arange(len(order)), 0))
        first_of_key = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        rank[active[order]] = base + first_of_key - first_of_group
        active, lane = active[left >= per_lane], lane + 1
    return rank


def by_doubling(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes as far as `cap` symbols tell, and the common prefix with the one before."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank], 1
    while width < cap and rank.max(initial=0) + 1 < n:
        later = np.zeros(n, np.int64)
        later[: max(n - width, 0)] = rank[width:]
        beyond = np.zeros(n, np.int64)
        beyond[max(n - width, 0) :] = 1  # the end is larger than any symbol
        key = (rank.astype(np.uint64) << np.uint64(33)) | (np.where(beyond == 1, 1 << 32, later)).astype(np.uint64)
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        width *= 2
    order = np.argsort(rank, kind="stable")
    x, y = order[:-1].copy(), order[1:].copy()
    total = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step, own = 1 << k, levels[k]
        for _ in range(1 + (k == len(levels) - 1)):
            fits = np.flatnonzero((x + step <= n) & (y + step <= n))
            same = fits[own[x[fits]] == own[y[fits]]]
            total[1:][same] += step
            x[same] += step
            y[same] += step
            x, y = np.minimum(x, n), np.minimum(y, n)
            if (np.maximum(x, y) >= n).any():
                own = np.append(own, -1) if len(own) == n else own
                levels[k] = own
    return order, np.minimum(total, cap).astype(np.uint16)


def common(text: np.ndarray, x: np.ndarray, y: np.ndarray, known: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of suffix pairs that are known to agree on their first symbols."""
    out = np.minimum(known, cap).astype(np.int64)
    n = len(text)
    active = np.flatnonzero(out < cap)
    while len(active):
        a, b = x[active] + out[active], y[active] + out[active]
        inside = (a < n) & (b < n)
        same = np.zeros(len(active), bool)
        same[inside] = text[a[inside]] == text[b[inside]]
        active = active[same]
        out[active] += 1
        active = active[out[active] < cap]
    return out.astype(np.uint16)


def stars(text: np.ndarray, s_type: np.ndarray) -> np.ndarray:
    return np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1


def star_order(text: np.ndarray, star: np.ndarray, cap: int, direct: int, folder: str, in_memory: int) -> tuple[np.ndarray, np.ndarray]:
    """The stars in suffix order, and the common prefix of each with the star before."""
    if not len(star):
        return star, np.empty(0, np.uint16)
    ends = np.append(star[1:], len(text) - 1)
    rank = piece_ranks(text, star, ends)
    values, names = np.unique(rank, return_inverse=True)
    names = names.astype(np.uint32)
    # A piece between stars has two symbols at least, but for the last one.
    order, shared = ordered(names, cap // 2 + 2, direct, folder, in_memory)
    x, y = order[:-1], order[1:]
    reach = np.append(star, len(text))
    shared = shared.astype(np.int64)
    known = np.zeros(len(order), np.int64)
    known[1:] = np.minimum(reach[np.minimum(x + shared[1:], len(star))] - star[x], reach[np.minimum(y + shared[1:], len(star))] - star[y])
    lcp = np.zeros(len(order), np.uint16)
    lcp[1:] = common(text, star[x], star[y], known[1:], cap)
    return star[order], lcp


def ordered(text: np.ndarray, cap: int, direct: int, folder: str, in_memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a text of ranks, by recursion while it is long."""
    if len(text) <= direct or text.max() + 1 == len(text):
        return by_doubling(text, cap)
    order, lcp = [], []
    for at, common_prefix in induced(text, cap, direct, folder, in_memory):
        order.append(at)
        lcp.append(common_prefix)
    return np.concatenate(order), np.concatenate(lcp)


def induced(text: np.ndarray, cap: int, direct: int = DIRECT, folder: str | None = None, in_memory: int = IN_MEMORY):
    """Blocks of all suffixes in order, each with its common prefix with the one before, capped.

    `text` holds uint8 symbols below 255, or uint32 symbols below 2^32 - 1; the end
    counts as larger than any symbol.
    """
    if folder is None:
        with tempfile.TemporaryDirectory(prefix="induced-") as own:
            yield from induced(text, cap, direct, own, in_memory)
        return
    n = len(text)
    if not n:
        return
    symbols = int(text.max()) + 1
    s_type = types(text)
    star, star_lcp = star_order(text, stars(text, s_type), cap, direct, folder, in_memory)
    first = text[star]
    star_bounds = np.searchsorted(first, np.arange(symbols + 1)) if symbols <= 4096 else None
    used = np.unique(text).tolist()

    def prepared(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol before each suffix, and whether there is one."""
        return text[np.maximum(at - 1, 0)], at > 0

    # Ascending: L suffixes, from the L and star suffixes before them.  The last suffix is an S unless the text falls to its end.
    large, kept = Queues(symbols, folder, in_memory), Queues(symbols, folder, in_memory)
    for c in used:
        source, last, entered = Source(symbols, cap, large), None, False
        for at, lcp in large.pop(c):
            lcp = lcp.copy()
            if not entered:
                lcp[0] = 0
            entered = True
            before, has = prepared(at)
            goes = has & (before >= c)
            kept.push(c, at, lcp)
            source.send(at, lcp, before, goes, False)
            last = int(at[-1])
        lo, hi = (star_bounds[c], star_bounds[c + 1]) if star_bounds is not None else np.searchsorted(first, [c, c + 1])
        for a in range(int(lo), int(hi), BLOCK):
            at, lcp = star[a : min(a + BLOCK, hi)], star_lcp[a : min(a + BLOCK, hi)].copy()
            if a == lo:
                lcp[0] = min(runs_of(text, last, cap), runs_of(text, int(at[0]), cap)) if last is not None else 0
            before, _ = prepared(at)
            source.send(at, lcp, before, np.ones(len(at), bool), a + BLOCK >= hi and not entered)
    # Descending: S suffixes, from the S and L suffixes after them.  Values are those with the next larger suffix.
    small, done = Queues(symbols, folder, in_memory), Queues(symbols, folder, in_memory)
    if s_type[-1]:
        small.push(int(text[-1]), np.array([n - 1]), np.zeros(1, np.uint16))
    for c in reversed(used):
        source, last, entered = Source(symbols, cap, small), None, False
        for at, lcp in small.pop(c):
            lcp = lcp.copy()
            if not entered:
                lcp[0] = 0
            entered = True
            before, has = prepared(at)
            goes = has & (before <= c)
            done.push(c, at, lcp)
            source.send(at, lcp, before, goes, False)
            last = int(at[-1])
        seam = 0
        largest = True
        for at, lcp, after in kept.backwards(c):
            lcp = lcp.copy()
            if largest:
                seam = min(runs_of(text, last, cap), runs_of(text, int(at[0]), cap)) if last is not None else 0
                lcp[0], largest = seam, False
            else:
                lcp[0] = after
            before, has = prepared(at)
            goes = has & (before < c)
            done.push(c, at, lcp)
            source.send(at, lcp, before, goes, False)
    for c in used:
        for at, lcp, after in done.backwards(c):
            lcp = lcp.copy()
            lcp[0] = 0 if after is None else after
            yield at, lcp
