"""N-gram Jaccard join by parity sketches (operator 6).

Texts with equal shingle sets are one class. In a size band, the shingle space is
cut into blocks and a class's sketch holds, for each block, the XOR of the hashes
of its shingles there. A shingle touches one block, so the number of blocks that
differ is at most the symmetric difference; two sets of similarity 0.8 or more
differ in at most (a + b) / 9 shingles. By pigeonhole it is enough to compare
classes that share one of their first k + 1 blocks, in any order common to all.
The order puts blocks that very many texts share last, and empty ones after them.

Texts are hashed twice: for sizes, names, bit sketches and counts of blocks, then
for the blocks to compare by. Blocks travel as packed arrays, one row for each
bucket and batch; blocks that many texts share are dealt by block and class, so
that none gathers in one bucket. Blocks with equal lists of classes are one group.

The classes of a group are compared by bit sketches, whose Hamming distance also
bounds the symmetric difference, in tiles of bounded size. A tile doesn't give all
close pairs but a spanning forest of them; those sets are intersected. Groups in
which pairs were left out are compared again between the components found so far,
until none is left out, so no pair that could tie two components is lost.

Links are counted afterwards: a link's ends are in one component, so within each
component all classes are compared with all others, in tiles, by the exact sizes
of their intersections. Only counts leave a tile, but the work of a component
grows with the square of its classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import States, tidy

SHINGLE, SHARE = 5, 80
#: Blocks that at least this many texts share go last; the threshold doubles until no more than this many are such (8 bytes each).
COMMON, MOST_COMMON = 32, 500_000
#: Rows of a few numbers up to which they are broadcast; beyond, the other side is shuffled to them.
BROADCAST_ROWS = 1_000_000
#: Classes of a group's or component's part and shingles of a component's part: pairs of parts are tiles, small ones share one. Shingles compared at once.
TILE, TILE_SHINGLES, COLUMNS = 512, 500_000, 8192
#: Shingles whose sketches (two to four bits each) a tile may hold, and bytes of sketches compared at once.
SKETCH_SHINGLES, SKETCH_BYTES = 8_000_000, 1 << 22
#: Classes of a tile up to which a table holds its pairs.
TABLE = 4096
#: Bytes of texts hashed at once (a longer text in stretches), blocks counted or packed at once, blocks in a bucket, names of texts remembered in a task.
AT_ONCE, COUNTED_AT_ONCE, PACKED_AT_ONCE, BUCKET_KEYS, REMEMBERED = 1 << 18, 1 << 20, 1 << 18, 1_000_000, 100_000
U = np.uint64
#: Base and its inverse modulo 2**64 of the rolling sum, and a table of odd words for bytes, all from one rule.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTES = mixed(np.arange(1, 257, dtype=np.uint64)) | U(1)
#: By byte: whether it is one of the six blanks, and the word of its lower-case form (A-Z only).
BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWERED = BYTES[np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))]


class Powers:
    """Powers of the base and of its inverse, as many as the longest stretch so far needs."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            more = max(n, 1 << 16)
            up, down = np.full(more, U(BASE)), np.full(more, U(_INVERSE))
            up[0] = down[0] = 1
            cls.up, cls.down = np.cumprod(up), np.cumprod(down)
        return cls.up[:n], cls.down[:n]


# --- sets of texts ---------------------------------------------------------------------------------------------------


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column (null: empty), and the places where they begin and the last one ends."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.fill_null("")
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64 if pa.types.is_large_string(column.type) else np.int32)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, at[column.offset : column.offset + len(column) + 1].astype(np.int64)


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of texts that stand one after the other, and how many words each has."""
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    blank, edge = BLANKS[raw], np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(~blank & (edge[:-1] | np.r_[True, blank[:-1]]))
    ends = np.flatnonzero(~blank & (edge[1:] | np.r_[blank[1:], True])) + 1
    up, down = Powers.to(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(LOWERED[raw] * up, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), np.diff(np.searchsorted(starts, bounds))


def words_of_long(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes() of one text in stretches that end before a blank."""
    parts, low = [np.empty(0, np.uint64)], 0
    while low < len(raw):
        high = min(low + AT_ONCE, len(raw))
        while high < len(raw) and not (blank := BLANKS[raw[high : high + AT_ONCE]]).any():
            high = min(high + AT_ONCE, len(raw))
        high += int(blank.argmax()) if high < len(raw) else 0
        parts.append(word_hashes(raw[low:high], np.array([0, high - low]))[0])
        low = high
    words = np.concatenate(parts)
    return words, np.array([len(words)])


def shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the shingles of each text, in order, and how many: the whole sequence of a shorter one, none without words."""
    starts = np.cumsum(counts) - counts
    n = np.where(counts >= size, counts - size + 1, counts > 0).astype(np.int64)
    begins, out = np.cumsum(n) - n, np.empty(int(n.sum()), np.uint64)
    for length in range(1, size + 1):
        own = counts >= size if length == size else counts == length
        if own.any():
            at = np.arange(len(out))[np.repeat(own, n)] + np.repeat((starts - begins)[own], n[own])
            made = words[at]
            for k in range(1, length):
                made = made * U(BASE) + words[at + k]
            out[np.repeat(own, n)] = mixed(made + U(length))
    return out, n


def distinct(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text, and how many."""
    ends = np.cumsum(n)
    for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True):
        h[a:b].sort()
    fresh = np.r_[True, h[1:] != h[:-1]] if len(h) else np.empty(0, bool)
    fresh[(ends - n)[n > 0]] = True
    total = np.r_[0, np.cumsum(fresh)]
    return h[fresh], total[ends] - total[ends - n]


def sets_in(column: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """low, high, hashes, n of some rows of a column of texts after the others: the sets of rows low to high, and their sizes."""
    raw, at = raw_texts(column)
    low = 0
    while low < len(at) - 1:
        high = max(low + 1, int(np.searchsorted(at, at[low] + AT_ONCE, "right")) - 1)
        part = raw[at[low] : at[high]]
        words, counts = word_hashes(part, at[low : high + 1] - at[low]) if len(part) <= AT_ONCE else words_of_long(part)
        yield low, high, *distinct(*shingles(words, counts, size))
        low = high


def set_names(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set; none may be empty."""
    first = np.cumsum(n) - n
    return (np.bitwise_xor.reduceat(mixed(h), first) ^ mixed(np.add.reduceat(h, first) + U(BASE))).view(np.int64) if len(n) else np.empty(0, np.int64)


def parity_bits(h: np.ndarray) -> bytes:
    """The parity sketch of a set: a power of two of bits, at least 256 and two for each shingle."""
    size = max(256, 1 << (2 * len(h) - 1).bit_length())
    odd = np.bincount((h & U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


# --- blocks ----------------------------------------------------------------------------------------------------------


def units(n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which sets stand in a unit, and in which (for sizes from 2**unit): each in its own, the smaller ones of it in the one below too."""
    own = np.frexp(n.astype(float))[1].astype(np.int64) - 1
    yield np.arange(len(n)), own
    low = np.flatnonzero((own > 0) & (4 * n <= 5 << own))
    if len(low):
        yield low, own[low] - 1


def blocks(h: np.ndarray, n: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each set's blocks in its unit, those without shingles left out, and how many."""
    text = np.repeat(np.arange(len(n)), n)
    place = (h >> U(1)) >> (63 - unit).astype(np.uint64)[text]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    word, text = np.bitwise_xor.reduceat(h, first), text[first]
    keys = mixed(word + mixed(place[first] * U(64) + unit.astype(np.uint64)[text]))
    return keys[word != 0], np.bincount(text[word != 0], minlength=len(n))


def all_blocks(h: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """which, unit, keys, counts of the blocks of sets, none of which is empty."""
    for which, unit in units(n):
        own = np.zeros(len(n), bool)
        own[which] = True
        yield which, unit, *blocks(h[np.repeat(own, n)], n[which], unit)


def prefix_lengths(n: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """k + 1, by the largest partner: what is larger than twice the unit's start meets its equals and larger ones in the next unit."""
    partner = np.where(n < 2 << unit, np.minimum(n * 5 // 4, (5 << unit) // 2), (2 << unit) - 1)
    return (n + partner) // 9 + 1


class Common:
    """Membership in the sorted keys of common blocks; most other keys are told by a table of their first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.first = keys, np.zeros(1 << 20, bool)
        self.first[keys >> U(44)] = True

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = self.first[keys >> U(44)]
        maybe = np.flatnonzero(out)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            out[maybe] = self.keys[at] == keys[maybe]
        return out


def prefix_blocks(h: np.ndarray, n: np.ndarray, common: Common) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys to compare by, and the sets that have them: the first k + 1 blocks of each unit, rare ones first; empty ones only where others don't suffice."""
    for which, unit, keys, counts in all_blocks(h, n):
        prefix = prefix_lengths(n[which], unit)
        order = (keys >> U(1)) | (common.of(keys).astype(np.uint64) << U(63))
        keep, ends = np.ones(len(keys), bool), np.cumsum(counts)
        for t in np.flatnonzero(counts > prefix).tolist():
            a, b, k = ends[t] - counts[t], ends[t], prefix[t]
            keep[a:b] = False
            keep[a + np.argpartition(order[a:b], k - 1)[:k]] = True
        yield keys[keep], np.repeat(which, counts)[keep]
        tiny = counts < prefix  # an empty block of the unit
        yield mixed(unit[tiny].astype(np.uint64) + U(1 << 40)), which[tiny]


# --- the two passes over the texts -----------------------------------------------------------------------------------

HASHED = "doc_id long, n long, cls long, bits binary, key long, times long"


def hashed(docs: DataFrame, size: int) -> DataFrame:
    """A row (doc_id, n, cls, bits) for each text: size, name and sketch of its set; without words n is 0 and the others are null.
    And rows (key, times) for blocks that several texts of a batch share; what occurs once in each batch is rare.

    Null texts are empty, repeated rows repeat.
    """

    def counts(keys: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(keys), return_counts=True)
        found, n = found[n > 1].view(np.int64), n[n > 1]
        none = [pa.nulls(len(n), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        return pa.RecordBatch.from_arrays([*none, pa.array(found), pa.array(n, pa.int64())], names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            for low, high, h, n in sets_in(batch.column(1), size):
                some, ends = n[n > 0], np.cumsum(n)
                cls = np.zeros(len(n), np.int64)
                cls[n > 0] = set_names(h, some)
                bits = [parity_bits(h[b - k : b]) if k else None for b, k in zip(ends.tolist(), n.tolist(), strict=True)]
                none = [pa.nulls(len(n), pa.int64())] * 2
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(n, pa.int64()), pa.array(cls, mask=n == 0), pa.array(bits, pa.binary()), *none], names)
                held += [keys for _, _, keys, _ in all_blocks(h, some)] if len(some) else []
                if sum(map(len, held)) >= COUNTED_AT_ONCE:
                    yield counts(held)
                    held = []
            if held:
                yield counts(held)

    names = [x.split()[0] for x in HASHED.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(each), HASHED)


def common_blocks(counts: DataFrame, states: States, least: int = COMMON, most: int = MOST_COMMON) -> np.ndarray:
    """The sorted keys of the most common blocks of counts (key, times), at most ``most``: only an order, so any choice gives the same links."""
    found = states.save(counts.groupBy("key").agg(F.sum("times").alias("n")).filter(F.col("n") >= least), "common")
    tier = F.floor(F.log2(F.col("n") / least))
    tiers = {r["tier"]: r["count"] for r in found.groupBy(tier.alias("tier")).count().collect()}  # at most 64 rows
    low = 0
    while sum(c for t, c in tiers.items() if t >= low) > most:
        low += 1
    return np.sort(found.filter(tier >= low).select("key").toPandas()["key"].to_numpy(np.int64).view(np.uint64))


KEYED = "bucket long, keys binary, classes binary"


def keyed(docs: DataFrame, common: np.ndarray, size: int, buckets: int) -> DataFrame:
    """bucket, keys, classes: the blocks to compare by of each text, packed. Common ones go to further buckets, by block and class.

    Null and empty texts have none; a copy may be left out if its task has seen the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)
    spread = buckets // 4 + 1

    def packed(keys: np.ndarray, classes: np.ndarray, known: Common) -> pa.RecordBatch:
        bucket = np.where(known.of(keys), buckets + (mixed(keys ^ classes) % U(spread)).astype(np.int64), ((keys >> U(20)) % U(buckets)).astype(np.int64))
        order = np.argsort(bucket, kind="stable")
        bucket, keys, classes = bucket[order], keys[order], classes[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]).tolist()
        of = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), of(keys), of(classes)], [x.split()[0] for x in KEYED.split(", ")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Common(shared.value), set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, _, h, n in sets_in(batch.column(0), size):
                n = n[n > 0]
                names = set_names(h, n)
                fresh = np.array([x not in seen and not seen.add(x) for x in names.tolist()], bool)
                if not fresh.any():
                    continue
                if len(seen) > REMEMBERED:
                    seen.clear()
                h, n, names = h[np.repeat(fresh, n)], n[fresh], names[fresh].view(np.uint64)
                held += [(keys, names[own]) for keys, own in prefix_blocks(h, n, known) if len(keys)]
                if sum(len(keys) for keys, _ in held) >= PACKED_AT_ONCE:
                    yield packed(*map(np.concatenate, zip(*held, strict=True)), known)
                    held = []
        if held:
            yield packed(*map(np.concatenate, zip(*held, strict=True)), known)

    return docs.select(F.col("text").cast("string")).mapInArrow(tidy(each), KEYED)


# --- groups and close pairs ------------------------------------------------------------------------------------------


def grouped(keys: DataFrame, buckets: int) -> DataFrame:
    """sig, cls: the classes of each group. A group is named by its classes, so that blocks with equal lists are one; a
    common block, whose classes stand in several buckets, by its key, and may turn out to have one class only."""

    def each(at: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        key, cls = (np.concatenate([np.frombuffer(x, np.uint64) for x in rows[c]]) for c in ("keys", "classes"))
        whole = at[0] < buckets
        if whole:  # most keys occur once
            order = np.argsort(key)
            key, cls = key[order], cls[order]
            alone = np.r_[True, key[1:] != key[:-1]] & np.r_[key[1:] != key[:-1], True]
            key, cls = key[~alone], cls[~alone]
        order = np.lexsort((cls, key))
        key, cls = key[order], cls[order]
        fresh = np.r_[True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])][: len(key)]
        key, cls = key[fresh], cls[fresh]
        if whole and len(key):
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            sig = np.bitwise_xor.reduceat(mixed(cls), first) ^ mixed(np.add.reduceat(cls, first) + U(BASE))
            _, one = np.unique(sig, return_index=True)
            keep = np.zeros(len(sig), bool)
            keep[one] = True
            keep &= size > 1
            key, cls = np.repeat(sig, size)[np.repeat(keep, size)], cls[np.repeat(keep, size)]
        return pd.DataFrame({"sig": key.view(np.int64), "cls": cls.view(np.int64)})

    return keys.groupBy("bucket").applyInPandas(each, "sig long, cls long").distinct()


def tiled(members: DataFrame, facts: DataFrame, bundle: int) -> DataFrame:
    """members with part, i, j, parts, tile: each part of a group (sig) with each other. Groups of one home share tiles, and
    groups of one part share them with others, by their shingles."""
    total = facts.filter("parts = 1").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()["total"]
    rows = members.join(facts.select("sig", "home", "parts"), "sig")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = F.when(F.col("parts") == 1, F.pmod("home", F.lit(total // bundle + 1))).otherwise(F.col("home"))
    return rows.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other"), "tile": tile}).drop("home", "other")


def group_facts(members: DataFrame, most_shingles: int) -> DataFrame:
    """sig, home, total (shingles), parts of each group (sig) of members (sig, cls, n) that has two classes or more; one of those with equal classes.

    home is the least hash of the group's classes, which groups of much the same classes mostly share.
    """
    name = F.xxhash64("cls")
    facts = members.groupBy("sig").agg(F.count("*").alias("g"), F.sum("n").alias("total"), F.bit_xor(name).alias("list"), F.min(name).alias("home")).filter("g > 1")
    parts = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("g") / TILE, F.col("total") / most_shingles, F.lit(1.0))))).cast("int")
    return facts.groupBy("list", "g", "total", "home").agg(F.min("sig").alias("sig")).select("sig", "home", "total", parts.alias("parts"))


def distances(bits: list[bytes], u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Hamming distances of the sketches of pairs; of two sizes, the larger is folded to the smaller: bits that fall together are added modulo two."""
    words = [np.frombuffer(x, np.uint64) for x in bits]
    width = np.array([len(x) for x in words])
    out, least = np.empty(len(u), np.int64), np.minimum(width[u], width[v])
    for w in np.unique(least).tolist():
        own = np.flatnonzero(least == w)
        for a in range(0, len(own), step := max(1, SKETCH_BYTES // (8 * w))):
            some = own[a : a + step]
            used, at = np.unique(np.r_[u[some], v[some]], return_inverse=True)
            folded = np.stack([np.bitwise_xor.reduce(words[x].reshape(-1, w), 0) for x in used.tolist()])
            out[some] = np.bitwise_count(folded[at[: len(some)]] ^ folded[at[len(some) :]]).sum(1)
    return out


def forest(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """Which of the distinct edges u, v make a spanning forest."""
    ends, other, edge = np.r_[u, v], np.r_[v, u], np.tile(np.arange(len(u)), 2)
    order = np.argsort(ends, kind="stable")
    other, edge = other[order], edge[order]
    at = np.searchsorted(ends[order], np.arange(nodes + 1))
    seen, picked = np.zeros(nodes, bool), np.zeros(len(u), bool)
    for root in np.unique(ends).tolist():
        todo = [] if seen[root] else [root]
        seen[root] = True
        while todo:
            x = todo.pop()
            near, own = other[at[x] : at[x + 1]], edge[at[x] : at[x + 1]]
            new = ~seen[near]
            picked[own[new]] = seen[near[new]] = True
            todo += near[new].tolist()
    return picked


def pairs_in_tile(rows: pd.DataFrame, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """sig, x, y (x below y) of the pairs of each group between the parts i and j of a tile; at gives the numbers of the rows' classes, and rows are sorted by sig and class."""
    sig, part, i, j = rows["sig"].to_numpy(), rows["part"].to_numpy(), rows["i"].iloc[0], rows["j"].iloc[0]
    cuts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1], True]).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = at[a:b]
        if i == j:
            yield sig[a], *(own[k] for k in np.triu_indices(b - a, 1))
        else:
            left, right = own[part[a:b] == i], own[part[a:b] == j]
            x, y = np.repeat(left, len(right)), np.tile(right, len(left))
            yield sig[a], np.minimum(x, y), np.maximum(x, y)


class PairSet:
    """Pairs of numbers below m, x below y: a table of bits where it is small, else sorted codes."""

    def __init__(self, m: int):
        self.m, self.held = m, 0
        self.table = np.zeros((m, m), bool) if m <= TABLE else None
        self.codes = [np.empty(0, np.int64)]

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        if self.table is not None:
            self.table[x, y] = True
            return
        self.codes.append(x * self.m + y)
        self.held += len(x)
        if self.held > COUNTED_AT_ONCE:
            self.pairs()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if self.table is not None:
            return np.nonzero(self.table)
        self.codes, self.held = [np.unique(np.concatenate(self.codes))], 0
        return self.codes[0] // self.m, self.codes[0] % self.m

    def any_of(self, x: np.ndarray, y: np.ndarray) -> bool:
        if self.table is not None:
            return bool(self.table[x, y].any())
        codes, own = self.codes[0], x * self.m + y  # after pairs()
        return bool(len(codes)) and bool((codes[np.minimum(np.searchsorted(codes, own), len(codes) - 1)] == own).any())


def close_in_tile(rows: pd.DataFrame, most: int | None) -> pd.DataFrame:
    """a, b of pairs of a tile's classes whose sizes and sketches allow a similarity of SHARE percent and whose components differ; a row with sig for each group of which a close pair is left out.

    most is None in the first round: a spanning forest of the close pairs. Then, of each two components, the closest ones.
    """
    rows = rows.sort_values(["sig", "cls"])
    cls, one, at = np.unique(rows["cls"].to_numpy(), return_index=True, return_inverse=True)
    n, label, bits = rows["n"].to_numpy()[one], np.unique(rows["component"].to_numpy()[one], return_inverse=True)[1], rows["bits"].to_numpy()[one]
    wanted = PairSet(len(cls))
    for _, x, y in pairs_in_tile(rows, at):
        wanted.add(x, y)
    u, v = wanted.pairs()
    fit = (100 * np.minimum(n[u], n[v]) >= SHARE * np.maximum(n[u], n[v])) & (label[u] != label[v])
    u, v = u[fit], v[fit]
    far = distances(list(bits), u, v)
    near = 9 * far <= n[u] + n[v]
    u, v, far = u[near], v[near], far[near]
    if most is None:
        keep = forest(u, v, len(cls))
    else:
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        order = np.lexsort((far / (n[u] + n[v]), high, low))
        first = np.flatnonzero(np.r_[True, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])][: len(order)])
        keep = np.zeros(len(order), bool)
        keep[order[np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)])) < most]] = True
    left = PairSet(len(cls))
    left.add(u[~keep], v[~keep])
    left.pairs()
    cut = [] if keep.all() else [sig for sig, x, y in pairs_in_tile(rows, at) if left.any_of(x, y)]
    return pd.DataFrame({"sig": pd.array([None] * int(keep.sum()) + cut, "Int64"), "a": pd.array(cls[u[keep]].tolist() + [None] * len(cut), "Int64"), "b": pd.array(cls[v[keep]].tolist() + [None] * len(cut), "Int64")})


def close_pairs(members: DataFrame, classes: DataFrame, most: int | None, states: States) -> DataFrame:
    """sig, a, b: close_in_tile() of all groups of members (sig, cls, n, component)."""
    facts = states.save(group_facts(members, SKETCH_SHINGLES), "facts")
    rows = tiled(members, facts, SKETCH_SHINGLES // 2).join(classes.select("cls", "bits"), "cls")
    return states.save(rows.groupBy("parts", "tile", "i", "j").applyInPandas(lambda rows: close_in_tile(rows, most), "sig long, a long, b long"), "close")


def sets_of(wanted: DataFrame, docs: DataFrame, size: int, states: States) -> DataFrame:
    """cls, h (its set) of each wanted (cls, doc_id): the texts of these doc_ids are read again."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, h, n in sets_in(batch.column(0), size):
                n = n[n > 0]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_names(h, n)), lists], ["cls", "h"])

    wanted = states.save(wanted, "wanted")
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    dealt = lambda x: F.broadcast(x) if small else x.hint("shuffle_hash")
    ids = dealt(wanted.select(F.col("doc_id").alias("_id")).distinct())
    texts = docs.select("doc_id", F.col("text").cast("string")).join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = texts.select("text").mapInArrow(tidy(each), "cls long, h array<long>")
    return states.save(found.join(dealt(wanted.select("cls")), "cls", "left_semi").dropDuplicates(["cls"]), "sets")  # another text may have the same doc_id


def linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, states: States) -> DataFrame:
    """The pairs (a, b) whose sets are similar: the texts of their classes are read again and the sets intersected."""
    pairs = states.save(pairs, "pairs")
    h = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes, "cls").select("cls", "doc_id"), docs, size, states)
    both = pairs.join(h.select(F.col("cls").alias("a"), F.col("h").alias("ha")), "a").join(h.select(F.col("cls").alias("b"), F.col("h").alias("hb")), "b")
    common = F.size(F.array_intersect("ha", "hb"))
    return both.filter(100 * common >= SHARE * (F.size("ha") + F.size("hb") - common)).select("a", "b")


def components(edges: DataFrame, states: States) -> DataFrame:
    """id, component (its least id) of every id on an edge (a, b): least labels spread along edges and along labels until none changes."""
    both = states.save(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")).distinct(), "edges")
    labels = states.save(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m")).select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, both["y"] == labels["id"]).groupBy("x").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["id"] == near["x"]).select("id", "component", F.least("component", "near").alias("next"))
        own = step.select(F.col("id").alias("up"), F.col("next").alias("over"))
        jump = states.save(step.join(own, step["next"] == own["up"], "left").select("id", F.least("next", F.coalesce("over", "next")).alias("now"), "component"), "labels")
        labels = jump.select("id", F.col("now").alias("component"))
        if not jump.filter("now <> component").head(1):
            return labels


# --- numbers of links ------------------------------------------------------------------------------------------------


def common_sizes(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of a has in common with each of b."""
    out = np.zeros((len(a), len(b)), np.int64)
    if not len(a) or not len(b):
        return out
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    flat = []
    for sets in (a, b):
        row, h = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
        known = np.isin(h, both)
        row, at = row[known], np.searchsorted(both, h[known])
        order = np.argsort(at, kind="stable")
        flat.append((row[order], at[order]))
    for start in range(0, len(both), COLUMNS):
        x, y = (np.zeros((len(sets), min(COLUMNS, len(both) - start)), np.float32) for sets in (a, b))
        for m, (row, at) in zip((x, y), flat, strict=True):
            cut = slice(*np.searchsorted(at, [start, start + COLUMNS]))
            m[row[cut], at[cut] - start] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def links_in_tile(rows: pd.DataFrame) -> pd.DataFrame:
    """cls, n_links: links between the part i and the part j of every component in a tile."""
    out = []
    for _, own in rows.groupby("sig"):
        i, j, part, cls = own["i"].iloc[0], own["j"].iloc[0], own["part"].to_numpy(), own["cls"].to_numpy()
        h = own["h"].to_numpy()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        n = np.array([len(x) for x in h], np.int64)
        common = common_sizes(list(h[left]), list(h[right]))
        near = 100 * common >= SHARE * (n[left][:, None] + n[right][None] - common)
        if i == j:
            np.fill_diagonal(near, False)
        out.append(pd.DataFrame({"cls": cls[left], "n_links": near.sum(1)}))
        if i != j:
            out.append(pd.DataFrame({"cls": cls[right], "n_links": near.sum(0)}))
    return pd.concat(out)


def degrees(table: DataFrame, docs: DataFrame, size: int, states: States) -> DataFrame:
    """cls, n_links: links of each class of table (cls, class_id, component, n), which holds those in components of two or more.

    In a component of two classes they are linked; in larger ones all pairs are compared.
    """
    members = table.withColumnRenamed("component", "sig")
    facts = states.save(group_facts(members, TILE_SHINGLES), "facts")
    of = members.groupBy("sig").agg(F.count("*").alias("m"))
    large = states.save(members.join(of.filter("m > 2"), "sig").select("sig", "cls", "class_id"), "members")
    pairs = members.join(of.filter("m = 2"), "sig").select("cls", F.lit(1).cast("long").alias("n_links"))
    h = sets_of(large.select("cls", F.col("class_id").alias("doc_id")), docs, size, states)
    rows = tiled(large.select("sig", "cls"), facts, TILE_SHINGLES).join(h, "cls")
    counts = rows.groupBy("parts", "tile", "i", "j").applyInPandas(links_in_tile, "cls long, n_links long")
    return states.save(pairs.union(counts.groupBy("cls").agg(F.sum("n_links").alias("n_links")).filter("n_links > 0")), "degrees")


# --- the operator ----------------------------------------------------------------------------------------------------


def labelled(docs: DataFrame, size: int, count: bool) -> DataFrame:
    """doc_id, n, component_id and, if they are to be counted, n_links of every row."""
    states = States(docs.sparkSession, "jaccard")
    made = states.save(hashed(docs, size), "hashed")
    rows = made.filter("times is null").select("doc_id", "n", "cls", "bits")
    classes = states.save(rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.count("*").alias("copies")), "classes")
    common = common_blocks(made.filter("times is not null").select("key", "times"), states)
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(64, total // 4 // BUCKET_KEYS)  # about a quarter as many keys as shingles
    members = states.save(grouped(keyed(docs, common, size, buckets), buckets).join(classes.select("cls", "n"), "cls"), "members")
    links = labels = most = None
    open_ = members.withColumn("component", F.col("cls"))
    while True:
        found = close_pairs(open_, classes, most, states)
        more = linked(found.filter("sig is null").select("a", "b").distinct(), classes, docs, size, states)
        links = states.save(more if links is None else links.union(more).distinct(), "links")
        labels = components(links, states)
        cut = found.filter("sig is not null").select("sig").distinct()
        known = members.join(cut, "sig").join(labels, F.col("cls") == F.col("id"), "left").select("sig", "cls", "n", F.coalesce("component", "cls").alias("component"))
        several = known.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("sig")
        open_ = states.save(known.join(several, "sig"), "open")
        if not open_.head(1):
            break
        most = 8 if most is None else 16 * most
    own = labels.join(classes.select("cls", F.col("doc_id").alias("class_id"), "n"), F.col("id") == F.col("cls")).select("cls", "class_id", "component", "n")
    least = own.groupBy("component").agg(F.min("class_id").alias("component_id"))
    table = states.save(own.join(least, "component"), "table")
    special = classes.select("cls", "doc_id", "copies").join(table.select("cls", F.col("component_id").alias("least")), "cls", "left").filter("copies > 1 or least is not null").select("cls", F.coalesce("least", "doc_id").alias("component_id"))
    if count:
        special = special.join(degrees(table, docs, size, states), "cls", "left")
    special = states.save(special, "special")
    states.clear("classes", "members", "sets")  # the large ones
    if special.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        special = F.broadcast(special)
    counts = [F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")] if count else []
    return rows.drop("bits").join(special, "cls", "left").select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"), *counts)


def joined(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (links of the row's class to all other classes) of every row.

    Null and empty texts have no shingles and link with nothing; rows are judged by their texts, so one doc_id with two
    texts can be in two components. A null doc_id keeps null as its component unless copies or links lead to a smaller
    id. Other columns aren't read.
    """
    return labelled(docs, size, count=True).withColumnRenamed("n", "n_shingles")


def keep_one(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """docs without near duplicates: of each component the rows of its least doc_id stay; texts without words and rows without doc_id stay."""
    rows = labelled(docs, size, count=False).filter("doc_id is not null")
    kept = F.max((F.col("component_id") == F.col("doc_id")).cast("int"))
    gone = States(docs.sparkSession, "copies").save(rows.groupBy(F.col("doc_id").alias("_gone")).agg(kept.alias("kept")).filter("kept = 0").select("_gone"), "gone")
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
