"""Similarity join of texts on word 5-grams, as a grouped prefix join.

Words are runs of characters other than ASCII white space, with A-Z in lower
case; a text's set holds its distinct 5-word shingles as 64-bit hashes, or the
whole sequence where it has fewer words.  Two texts link if
100 * |intersection| >= 80 * |union|.

* Rare shingles come first in the common order: those that a bounded summary of
  all texts (`HEAVY` counters) knows to be frequent come last.  The order decides
  how much work there is, not what is found.
* Linked texts share a shingle among the first n - ceil(0.8 n) + 1 of each.
  Texts with equal sets are one class; classes with equal prefix and size are
  one group, and only groups meet in the lists of a shingle.
* Pairs of groups pass by size, by what can still follow the common shingle and,
  inside the list, by the parities of their shingles' hashes, a bound that no link
  breaks.  A list of texts that only share a passage so proposes nothing, however
  long it is.  Groups of several classes have no parities of their own: their
  pairs are expanded to classes, which pass by theirs.  What passes is verified
  on whole sets.
* Texts that are already in one component need no further test.  So the lists are
  walked in rounds: a round proposes a few partners for each group, in other
  components; the links found join components; the next round may propose eight
  times as many.  Only lists in which a group had more partners than it was
  allowed to propose are walked again, and no pair is judged twice.  The last
  round is the one without such lists, so no link between components is missed.
* A list of a shingle that the summary knows in more than `BLOCK` texts is dealt
  into blocks, and blocks meet in pairs, so no task holds a whole hot list.

Texts without words (NULL and empty ones too) have an empty set, link with
nothing and are their own component.  Rows are judged one by one; rows that share
a doc_id may so lie in different components.  A component whose rows all have a
NULL doc_id has a NULL id.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.llm import bloom
from mensura.llm import text as tx
from mensura.llm.components import components, stored

SHINGLE = 5
SHARE = 80  # percent
HEAVY, COUNTED = 1 << 16, 2 << 20  # shingles kept in a summary, and counted at once
BITS, UP_TO = (256, 512, 1024, 2048), (400, 800, 1600)  # of a set's parities, and the sizes up to which fewer are enough
BLOCK = 4096
MOST = 1 << 20  # rows of a batch that a task handles at once


def block_sets(block: tx.Block) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of the distinct shingles of a block, sorted by both."""
    starts, ends, first = tx.runs(block, tx.NOT_SPACE)
    words = tx.hash_spans(block.data, starts, ends - starts)
    h, _, of = tx.windows(words, first, SHINGLE)
    counts = np.diff(first)
    for n in range(1, SHINGLE):
        few = np.flatnonzero(counts == n)
        if len(few):
            whole, _, _ = tx.windows(words[(first[few][:, None] + np.arange(n)).ravel()], np.arange(0, n * len(few) + 1, n), n)
            h, of = np.append(h, tx.mix(whole + np.uint64(n))), np.append(of, few)
    order = np.argsort(of, kind="stable")
    return tx.distinct_pairs(of[order], h[order])


def least_common(a, b):
    """Least overlap of two linked sets of these sizes."""
    return -(-SHARE * (a + b) // (100 + SHARE))


# --- the order -----------------------------------------------------------------------------


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summary of a task's shingles: counts of the HEAVY most frequent of those that some millions hold more than once."""
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    held: list[np.ndarray] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        u, c = np.unique(np.concatenate(held), return_counts=True)
        both = np.concatenate([keys, u[c > 1]])
        found, at = np.unique(both, return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([counts, c[c > 1]]), minlength=len(found)).astype(np.int64)
        if len(found) > HEAVY:
            top = np.sort(np.argpartition(total, len(total) - HEAVY)[len(total) - HEAVY :])
            found, total = found[top], total[top]
        return found, total

    for batch in batches:
        for block in tx.blocks(batch, lower=True):
            held.append(block_sets(block)[1])
            if sum(map(len, held)) > COUNTED:
                keys, counts = merged()
                held = []
    if held:
        keys, counts = merged()
    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["h", "n"])


def frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts; at most HEAVY rows of 16 bytes reach the driver."""
    found = texts.mapInArrow(_frequent, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = found.where("n > 2").orderBy(F.desc("n"), "h").limit(HEAVY).toArrow()
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    return h[order].copy(), n[order].copy()


class Order:
    """The common order of shingles: frequent ones last, by their count, then all by their hash."""

    def __init__(self, heavy: np.ndarray, counts: np.ndarray):
        self.heavy, self.counts = heavy, counts
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(heavy >> np.uint64(44)).astype(np.int64)] = True

    def rank(self, h: np.ndarray) -> np.ndarray:
        """Count of each shingle in the summary, 0 for those it does not hold."""
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.heavy, h[some]), len(self.heavy) - 1)
            out[some] = np.where(self.heavy[at] == h[some], self.counts[at], 0)
        return out

    def arranged(self, of: np.ndarray, h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The sets in the common order; they come sorted by hash within each text."""
        rank = self.rank(h)
        light = rank == 0
        if light.all():
            return h
        out = np.empty_like(h)
        before = np.concatenate([[0], np.cumsum(light)])
        n_light = before[bounds[1:]] - before[bounds[:-1]]
        own = np.flatnonzero(light)
        out[bounds[of[own]] + np.arange(len(own)) - before[bounds[of[own]]]] = h[own]
        heavy = np.flatnonzero(~light)
        heavy = heavy[np.lexsort((h[heavy], rank[heavy], of[heavy]))]
        first = bounds[of[heavy]] - before[bounds[of[heavy]]]  # heavy ones of the texts before
        out[bounds[of[heavy]] + n_light[of[heavy]] + np.arange(len(heavy)) - first] = h[heavy]
        return out


# --- classes, groups and prefixes ----------------------------------------------------------


def folded(values: np.ndarray, bounds: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each run of values, in their order."""
    place = np.arange(len(values)) - np.repeat(bounds[:-1], np.diff(bounds))
    with np.errstate(over="ignore"):
        each = tx.mix(values ^ tx.mix(place.astype(np.uint64) * np.uint64(2 * seed + 1) + np.uint64(seed)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(each, dtype=np.uint64)])
    return tx.mix((total[bounds[1:]] - total[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64))


def parities(of: np.ndarray, h: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set, which of some classes of hashes (`BITS`, by its size) have an odd number of its shingles.

    Two such patterns differ in no more places than the sets have shingles that
    only one of them holds.
    """
    bits = np.array(BITS)[np.searchsorted(UP_TO, sizes)]
    bounds = np.concatenate([[0], np.cumsum(bits)])
    cells = np.bincount(bounds[of] + (h & (bits[of] - 1).astype(np.uint64)).astype(np.int64), minlength=int(bounds[-1]))
    packed, at = np.packbits((cells & 1).astype(bool)), (bounds // 8).tolist()
    return [packed[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]


class Parities:
    """Patterns of a column; a longer one is folded to the length of a shorter one.  NULL is a pattern that tells nothing."""

    def __init__(self, patterns: list[bytes | None]):
        self.width = np.array([len(x) if x else 0 for x in patterns], np.int64)
        data = np.frombuffer(b"".join(x for x in patterns if x), np.uint8)
        self.folds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rows, table = np.empty(0, np.int64), np.empty((0, BITS[-1] // 8), np.uint8)
        for w in (b // 8 for b in reversed(BITS)):
            own = self.width == w
            folded_ones = table if table.shape[1] == w else table[:, :w] ^ table[:, w:]
            rows = np.append(rows, np.flatnonzero(own))
            table = np.concatenate([folded_ones, data[np.repeat(own, self.width)].reshape(-1, w)])
            place = np.zeros(len(own), np.int32)
            place[rows] = np.arange(len(rows))
            self.folds[w] = (place, table.view(np.uint64))

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Least number of shingles that only one of both sets holds."""
        out, width = np.zeros(len(x), np.int64), np.minimum(self.width[x], self.width[y])
        for w, (place, table) in self.folds.items():
            own = np.flatnonzero(width == w)
            out[own] = np.bitwise_count(table[place[x[own]]] ^ table[place[y[own]]]).sum(axis=1, dtype=np.int64)
        return out


def _prefixes(order: Order, carry: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, class, group and parities of each row, and the prefix of each group once a task."""
    seen: set[int] = set()
    for batch in batches:
        for block in tx.blocks(batch, "__text", lower=True):
            of, h = block_sets(block)
            sizes = np.bincount(of, minlength=len(block))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            cid = folded(h, bounds, 1)
            length = np.where(sizes > 0, sizes + (-SHARE * sizes) // 100 + 1, 0)
            place = np.arange(len(h)) - np.repeat(bounds[:-1], sizes)
            first = order.arranged(of, h, bounds)[place < np.repeat(length, sizes)]
            own = np.concatenate([[0], np.cumsum(length)])
            gid = folded(first, own, 2) ^ tx.mix(sizes.astype(np.uint64))
            prefixes = []
            for i, g in enumerate(gid.tolist()):
                new = sizes[i] > 0 and g not in seen
                prefixes.append(first[own[i] : own[i + 1]].tobytes() if new else None)
                if new:
                    seen.add(g)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(block.lo, len(block)) for c in carry), pa.array(sizes), pa.array(cid.view(np.int64)), pa.array(gid.view(np.int64)), pa.array(parities(of, h, sizes), pa.binary()), pa.array(prefixes, pa.binary())],
                names=[*carry, "n", "cid", "gid", "parity", "prefix"],
            )


def _postings(order: Order, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            raw = part.column("prefix").to_pylist()
            sizes = np.array([len(x) // 8 for x in raw], np.int64)
            h = np.frombuffer(b"".join(raw), np.uint64)
            gid = np.repeat(part.column("gid").to_numpy(), sizes)
            n = np.repeat(part.column("n").to_numpy(), sizes)
            place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            blocks = np.maximum(1, -(-order.rank(h) // BLOCK))
            salt = (tx.mix(gid.view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(salt), pa.array(blocks.astype(np.int32)), pa.array(gid), pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32))],
                names=["token", "salt", "blocks", "gid", "n", "place"],
            )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition whose token another group has as well, or may have in another block; each group once."""
    pending, matched = None, False
    for batch in batches:
        if pending is not None:
            batch = pa.Table.from_batches([pending, batch]).combine_chunks().to_batches()[0]
        token, gid = batch.column("token").to_numpy(), batch.column("gid").to_numpy()
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (gid[1:] != gid[:-1])
        batch, token = batch.filter(pa.array(new)), token[new]
        same = token[1:] == token[:-1]
        shared = batch.column("blocks").to_numpy() > 1
        shared[1:] |= same
        shared[:-1] |= same
        shared[0] |= matched
        yield batch.filter(pa.array(np.append(shared[:-1], False)))
        pending, matched = batch.slice(len(token) - 1), bool(shared[-1])
    if pending is not None and matched:
        yield pending


# --- rounds --------------------------------------------------------------------------------

_LIST = ["token", "i", "j", "salt", "kind", "e", "n", "place", "lo", "hi"]


def proposals(rows: dict[str, np.ndarray], signs: Parities, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries of one list that may link and lie in different components.

    Every entry looks back over the entries before it in its list and takes up to
    `most`.  Lists have one order, so that entries which share many lists propose
    the same few pairs in all of them.  Gives kind and both entries of each pair,
    and kind and token of the lists in which an entry could have taken more.
    """
    order = np.lexsort((tx.mix(rows["e"].view(np.uint64)), rows["j"], rows["i"], rows["token"], rows["kind"]))
    r = {k: v[order] for k, v in rows.items()}
    new = np.ones(len(order), bool)
    for k in ("token", "i", "j", "kind"):
        new[1:] &= r[k][1:] == r[k][:-1]
    new = ~new
    new[:1] = True
    start = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.empty(0, np.int64)
    taken = np.zeros(len(order), np.int64)
    active, back = np.arange(len(order)), 0
    left, right, more = [], [], []
    while len(active):
        back += 1
        active = active[active - back >= start[active]]
        x, y = active - back, active
        na, nb = r["n"][x], r["n"][y]
        rest = np.minimum(na - r["place"][x], nb - r["place"][y])
        fits = (r["e"][x] != r["e"][y]) & (rest >= least_common(na, nb))
        fits &= SHARE * np.maximum(na, nb) <= 100 * np.minimum(na, nb)
        fits &= ~((r["lo"][x] == r["hi"][x]) & (r["lo"][y] == r["hi"][y]) & (r["lo"][x] == r["lo"][y]))
        fits &= (r["i"][y] == r["j"][y]) | (r["salt"][x] != r["salt"][y])
        x, y = x[fits], y[fits]
        common = least_common(r["n"][x], r["n"][y])
        fits = signs.apart(order[x], order[y]) <= r["n"][x] + r["n"][y] - 2 * common
        x, y = x[fits], y[fits]
        full = taken[y] >= most
        more.append(y[full])
        left.append(x[~full])
        right.append(y[~full])
        taken[y] += 1
        if len(y):
            active = active[taken[active] <= most]
    x, y, z = (np.concatenate([np.empty(0, np.int64), *v]) for v in (left, right, more))
    a, b = np.minimum(r["e"][x], r["e"][y]), np.maximum(r["e"][x], r["e"][y])
    pairs = np.unique(np.stack([r["kind"][x], a, b], 1), axis=0)
    return pairs, np.unique(np.stack([r["kind"][z], r["token"][z]], 1), axis=0)


def _propose(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a sorted partition, some whole lists at a time; rows with `more` name the lists that could propose more, by their token in a."""

    def emit(table: pa.Table) -> pa.RecordBatch:
        pairs, more = proposals({c: table.column(c).to_numpy() for c in _LIST}, Parities(table.column("parity").to_pylist()), most)
        kind, a = np.concatenate([pairs[:, :2], more]).T
        b = np.append(pairs[:, 2], np.zeros(len(more), np.int64))
        flag = np.arange(len(a)) >= len(pairs)
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b), pa.array(flag)], names=["kind", "a", "b", "more"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < MOST // 8:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = {c: table.column(c)[rows - 1].as_py() for c in ("kind", "token", "i", "j")}
        whole = np.zeros(rows, bool)
        for c, v in last.items():
            whole |= table.column(c).to_numpy() != v
        stop = int(np.flatnonzero(whole)[-1]) + 1 if whole.any() else 0
        if stop:
            yield emit(table.slice(0, stop))
        rest = table.slice(stop)
        held, rows = rest.combine_chunks().to_batches(), rest.num_rows
    if rows:
        yield emit(pa.Table.from_batches(held).combine_chunks())


def _sets(packed: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the texts that the filter lets through, each class once a task."""
    table, seen = bloom.unpacked(packed), set()
    for batch in batches:
        batch = batch.filter(pa.array(bloom.may_hold(table, batch.column("key").to_numpy().view(np.uint64))))
        for block in tx.blocks(batch, lower=True):
            of, h = block_sets(block)
            bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(block)))])
            cid = folded(h, bounds, 1)
            keep = [i for i in np.flatnonzero(np.diff(bounds) > 0).tolist() if not (cid[i] in seen or seen.add(cid[i]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[keep].view(np.int64)), pa.array([h[bounds[i] : bounds[i + 1]].tobytes() for i in keep], pa.binary())], names=["cid", "shingles"]
            )


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose parities leave room for a link."""
    for batch in batches:
        rows = np.arange(batch.num_rows)
        signs = Parities(batch.column("x").to_pylist() + batch.column("y").to_pylist())
        nx, ny = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(signs.apart(rows, rows + len(rows)) <= nx + ny - 2 * least_common(nx, ny)))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= SHARE * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def links(spark: SparkSession, texts: DataFrame, classes: DataFrame, lists: DataFrame) -> DataFrame:
    """v, root: the components of all classes that link with another one.

    `classes` has cid, gid and n of each class, `lists` the shared postings.
    """
    sizes = classes.groupBy("gid").agg(F.count(F.lit(1)).alias("m"))
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    # Classes of one group share their whole prefix: they are a list as well.
    inner = classes.join(sizes.where("m > 1"), "gid").select(
        F.col("gid").alias("token"), F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("salt"), blocks.alias("blocks"),
        F.col("cid").alias("e"), F.col("n").cast("int").alias("n"), F.lit(0).alias("place"), F.lit(1).cast("long").alias("kind"),
    )
    outer = lists.select("token", "salt", "blocks", F.col("gid").alias("e"), "n", "place", F.lit(0).cast("long").alias("kind"))
    entries = stored(outer.unionByName(inner), "lists")
    home = spark.createDataFrame([], "v long, root long")
    found = spark.createDataFrame([], "a long, b long")
    judged = spark.createDataFrame([], "kind long, a long, b long")
    most = 4
    while True:
        rooted = classes.join(home, F.col("cid") == F.col("v"), "left").select("cid", "gid", F.col("n").cast("long").alias("n"), "parity", F.coalesce("root", "cid").alias("root"))
        alone = F.when(F.count(F.lit(1)) == 1, F.first("parity")).alias("parity")
        of_group = rooted.groupBy(F.col("gid").alias("of")).agg(F.min("root").alias("lo"), F.max("root").alias("hi"), alone).withColumn("of_kind", F.lit(0).cast("long"))
        of_class = rooted.join(sizes.where("m > 1"), "gid").select(F.col("cid").alias("of"), F.col("root").alias("lo"), F.col("root").alias("hi"), "parity", F.lit(1).cast("long").alias("of_kind"))
        placed = entries.join(of_group.unionByName(of_class), (F.col("e") == F.col("of")) & (F.col("kind") == F.col("of_kind")))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        dealt = placed.withColumn("x", other).select(
            "token", F.least("salt", "x").alias("i"), F.greatest("salt", "x").alias("j"), "salt", "kind", "e", "n", "place", "lo", "hi", "parity"
        )
        sorted_lists = dealt.repartition("token", "i", "j").sortWithinPartitions("kind", "token", "i", "j")
        proposed = stored(sorted_lists.mapInArrow(partial(_propose, most), "kind long, a long, b long, more boolean"), "proposed")
        pairs = proposed.where("not more").select("kind", "a", "b").distinct().join(judged, ["kind", "a", "b"], "left_anti")
        member = rooted.select("gid", "cid", "root", "n", "parity")
        by_group = pairs.where("kind = 0").join(member.withColumnsRenamed({"gid": "a", "cid": "p", "root": "p_root", "n": "nx", "parity": "x"}), "a")
        by_group = by_group.join(member.withColumnsRenamed({"gid": "b", "cid": "q", "root": "q_root", "n": "ny", "parity": "y"}), "b").where("p_root <> q_root")
        plausible = by_group.select(F.col("p").alias("a"), F.col("q").alias("b"), "nx", "ny", "x", "y").mapInArrow(_plausible, "a long, b long")
        # No pair of classes comes twice: those of kind 1 share their group, others have one pair of groups.
        expanded = stored(plausible.unionByName(pairs.where("kind = 1").select("a", "b")), "pairs")
        if not expanded.isEmpty():
            wanted = classes.select("cid", "key").join(expanded.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "cid")
            table = bloom.packed(bloom.collect(wanted, "key"))
            sets = texts.mapInArrow(partial(_sets, table), "cid long, shingles binary").join(wanted.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])
            left = expanded.join(sets.withColumnsRenamed({"cid": "a", "shingles": "x"}), "a")
            both = left.join(sets.withColumnsRenamed({"cid": "b", "shingles": "y"}), "b")
            new = stored(both.mapInArrow(_linked, "a long, b long"), "linked")
            if not new.isEmpty():
                found = found.unionByName(new)
                home = components(spark, found)
        again = proposed.where("more").select("kind", F.col("a").alias("token")).distinct()
        if again.isEmpty():
            return home
        entries = stored(entries.join(again, ["kind", "token"], "left_semi"), "lists")
        judged = judged.unionByName(proposed.where("not more").select("kind", "a", "b"))
        most *= 8


def joined(spark: SparkSession, documents: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns of each row, n_shingles, cid, root and component_id (the smallest doc_id of its component).

    doc_id must be among the carried columns.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = documents.select(text.alias("text"), F.xxhash64(text).alias("key"))
    order = Order(*frequent(texts))
    carried = (*carry, "key")
    rows = documents.select(*carry, F.xxhash64(text).alias("key"), text.alias("__text"))
    schema = rows.select(*carried).schema.add("n", "long").add("cid", "long").add("gid", "long").add("parity", "binary").add("prefix", "binary")
    table = stored(rows.mapInArrow(partial(_prefixes, order, carried), schema), "prefixes")
    per_class = [F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("gid", "n", "parity", "key"))]
    classes = stored(table.where("n > 0").groupBy("cid").agg(*per_class), "classes")
    postings = table.where("prefix is not null").select("gid", "n", "prefix").mapInArrow(
        partial(_postings, order), "token long, salt int, blocks int, gid long, n int, place int"
    )
    lists = postings.repartition("token", "salt").sortWithinPartitions("token", "gid").mapInArrow(_shared, postings.schema)
    home = links(spark, texts, classes, lists)
    rooted = classes.join(home, F.col("cid") == F.col("v"), "left").select("cid", "doc_id", F.coalesce("root", "cid").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = rooted.join(least, "root").select(F.col("cid").alias("c"), "root", "component_id")
    return table.select(*carry, "n", "cid").join(ids, (F.col("cid") == F.col("c")) & (F.col("n") > 0), "left").select(
        *carry, F.col("n").alias("n_shingles"), "cid", "root", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def similarity_join(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return joined(spark, rows).select("doc_id", "n_shingles", "component_id")


def one_of_each(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The documents, all their columns, of which one of each component stays: a row with the smallest doc_id.

    Rows without words all stay.
    """
    named = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    verdicts = joined(spark, named.select("doc_id", "text"))
    kept = verdicts.where("root is not null and doc_id <=> component_id").groupBy("root").agg(F.min("doc_id").alias("keep_id"), F.min("cid").alias("keep_cid"))
    # Only the texts travel to Python.  A filter would repeat a deterministic function, so this one is not called that.
    marked = named.select("row", "doc_id", _mark.asNondeterministic()("text").alias("mark"))
    chosen = marked.join(kept.select("keep_id", "keep_cid"), (F.col("mark.cid") == F.col("keep_cid")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).where("mark.n > 0")
    single = chosen.dropDuplicates(["keep_cid"]).select("row.*")
    return single.unionByName(marked.where("mark.n = 0").select("row.*"))


@F.arrow_udf(T.StructType().add("n", "long").add("cid", "long"))
def _mark(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Size and class of each text's set."""
    for text in texts:
        n, cid = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for block in tx.blocks(pa.RecordBatch.from_arrays([text], names=["text"]), lower=True):
            of, h = block_sets(block)
            bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(block)))])
            n.append(np.diff(bounds))
            cid.append(folded(h, bounds, 1))
        yield pa.StructArray.from_arrays([pa.array(np.concatenate(n).astype(np.int64)), pa.array(np.concatenate(cid).view(np.int64))], names=["n", "cid"])
