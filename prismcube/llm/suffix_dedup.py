"""Removal of repeated byte strings by a distributed difference-cover suffix sort (operator 4).

A difference cover D of period v is a set of residues such that for any two
positions i, j there is a shift d < v that moves both onto sampled positions. So
any two equal strings of ``length`` bytes hold a pair of sampled suffixes, at the
same offset below v, that agree on the next length - v + 1 bytes.

1. Sampled suffixes are named by a hash of that prefix and sorted by name in
   buckets; suffixes whose neighbour has the same name are kept. (Prefixes are as
   long as needed here, so one level of names does what recursion does for whole
   suffixes.) The period suits strings of three quarters of ``length`` bytes, so
   that kept suffixes also tell of repeated passages that are too short to go.
2. The remaining suffixes that can repeat are those less than v before a kept one.
   They are merged in by the name of their own first ``length`` bytes, sorted with
   the others of their bucket, and adjacent equal prefixes are marked.
3. Marked places, each ``length`` bytes long, are united and cut out of each text.

Texts are keyed by a 64-bit hash, so copies of a text are one text that is removed
whole. Names and places travel as packed arrays, one row for each bucket and batch, so
the sort costs no row for each suffix. A name that stands several times in a batch is
marked there at once and sent on by one of its places, so that a passage that very many
texts share brings its bucket one entry for each batch. Names are 64 bits of a rolling
hash with a mixed finaliser; two different strings of one name would need a chance of 2**-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import States, text_of
from prismcube.llm.parity_join import BYTES, Powers, mixed

LENGTH = 400
#: Perfect difference sets, period by period.
COVERS = {
    183: (0, 2, 3, 10, 26, 39, 43, 61, 109, 121, 130, 136, 141, 155),
    133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    13: (0, 1, 3, 9),
    7: (1, 2, 4),
    3: (0, 1),
    1: (0,),
}
#: Names in a bucket, about; starts hashed at once. Both bound memory only.
BUCKET_NAMES, STARTS_AT_ONCE = 1_000_000, 1 << 19
#: Keys of texts, and rows of the results by text, up to which they are broadcast; beyond, rows are shuffled to them.
BROADCAST_KEYS, BROADCAST_ROWS = 1_000_000, 200_000
U = np.uint64
PACKED = "bucket int, keys binary, counts binary, names binary, gaps binary"
SENT = "target int, keys binary, counts binary, gaps binary"
PLACES = "k long, n long, places binary"


def passage_of(length: int) -> int:
    """The bytes from which a repeated passage is told, though not removed."""
    return max(1, 3 * length // 4)


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The longest period below half of a passage's length, and its residues."""
    v = max(p for p in COVERS if p == 1 or 2 * p < passage_of(length))
    return v, np.array(COVERS[v], np.int64)


def prefix_names(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The names of the strings of ``length`` bytes at rising starts."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), STARTS_AT_ONCE):
        some = starts[i : i + STARTS_AT_ONCE]
        low = 0
        while low < len(some):  # stretches of the text, so that the powers stay short
            base = some[low]
            high = int(np.searchsorted(some, base + STARTS_AT_ONCE))
            at = some[low:high] - base
            part = raw[base : base + at[-1] + length]
            up, down = Powers.to(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(BYTES[part] * up[:-1], out=sums[1:])
            out[i + low : i + high] = mixed((sums[at + length] - sums[at]) * down[at])
            low = high
    return out


def gaps_of(places: np.ndarray, starts: np.ndarray) -> bytes:
    """Places as differences within a key; starts: where the keys begin. Two bytes each, or four if one doesn't fit."""
    gaps = np.diff(places, prepend=0)
    gaps[starts] = places[starts]
    return (b"2" + gaps.astype(np.uint16).tobytes()) if not len(gaps) or gaps.max() < 1 << 16 else (b"4" + gaps.astype(np.uint32).tobytes())


def places_of(raw: bytes, counts: np.ndarray) -> np.ndarray:
    gaps = np.frombuffer(raw, np.uint16 if raw[:1] == b"2" else np.uint32, offset=1).astype(np.int64)
    total = np.cumsum(gaps)
    first = np.cumsum(counts) - counts
    return total - np.repeat(total[first] - gaps[first], counts) if len(gaps) else gaps


def bundles(bucket: np.ndarray, keys: np.ndarray, places: np.ndarray, names: np.ndarray | None = None) -> list[tuple]:
    """(bucket, keys, counts, names, gaps) for each bucket; within one, a key's entries follow each other and its places rise."""
    cuts, out = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]), []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = keys[a:b]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts = np.diff(np.r_[first, b - a]).astype(np.uint32)
        out.append((int(bucket[a]), own[first].tobytes(), counts.tobytes(), b"" if names is None else names[a:b].tobytes(), gaps_of(places[a:b], first)))
    return out


def targets_of(keys: np.ndarray, targets: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) % U(targets)).astype(np.int64)


class Packer:
    """Collects (key, names, places) of different texts and hands them out by bucket, places marked already by target after the buckets."""

    def __init__(self, buckets: int, targets: int):
        self.buckets, self.targets, self.size = buckets, targets, 0
        self.keys: list[int] = []
        self.names: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, key: int, names: np.ndarray, places: np.ndarray) -> None:
        if len(names):
            self.keys.append(key)
            self.names.append(names)
            self.places.append(places)
            self.size += len(names)

    def rows(self) -> pd.DataFrame:
        columns = [x.split()[0] for x in PACKED.split(", ")]
        if not self.keys:
            return pd.DataFrame(columns=columns)
        names, places = np.concatenate(self.names), np.concatenate(self.places)
        keys = np.repeat(np.array(self.keys, np.int64), [len(x) for x in self.names])
        order = np.argsort(names)
        new = np.r_[True, names[order][1:] != names[order][:-1]]
        several = ~(new & np.r_[new[1:], True])
        marked, sent = np.sort(order[several]), np.sort(order[new])  # in the order of texts and places again
        bucket = ((names[sent] >> U(40)) % U(self.buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        out = bundles(bucket[by], keys[sent][by], places[sent][by], names[sent][by])
        if len(marked):
            target = self.buckets + targets_of(keys[marked], self.targets)
            by = np.argsort(target, kind="stable")
            out += bundles(target[by], keys[marked][by], places[marked][by])
        self.__init__(self.buckets, self.targets)
        return pd.DataFrame(out, columns=columns)


def packed(rows: DataFrame, buckets: int, names: Callable[[dict], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """The packed names of all texts; names gives those of one row (a dict of its columns) and their places."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, seen = Packer(buckets, targets_for(buckets)), set()
        for some in batches:
            for row in some.to_dict("records"):
                if row["k"] in seen:  # a copy within the task
                    continue
                seen.add(row["k"])
                packer.add(row["k"], *names(row))
                if packer.size >= 3 * BUCKET_NAMES // 2:
                    yield packer.rows()
        yield packer.rows()

    return rows.mapInPandas(each, PACKED)


def targets_for(buckets: int) -> int:
    """Buckets send what they mark to a quarter as many targets by key."""
    return max(4, buckets // 4)


def bundled(keys: np.ndarray, places: np.ndarray, targets: int) -> pd.DataFrame:
    """Keys and places packed by target, one row for each target."""
    target = targets_of(keys, targets)
    order = np.lexsort((places, keys, target))
    out = bundles(target[order], keys[order], places[order])
    return pd.DataFrame([(t, k, n, g) for t, k, n, _, g in out], columns=["target", "keys", "counts", "gaps"])


def unbundled(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys and places of packed rows."""
    counts = [np.frombuffer(x, np.uint32).astype(np.int64) for x in rows["counts"]]
    keys = np.concatenate([np.repeat(np.frombuffer(x, np.int64), n) for x, n in zip(rows["keys"], counts, strict=True)])
    return keys, np.concatenate([places_of(x, n) for x, n in zip(rows["gaps"], counts, strict=True)])


def repeated(names: DataFrame, buckets: int) -> DataFrame:
    """k, places: of every bucket, sorted by name, the places whose name another text or place has too (copies of a text have its key).

    Buckets send what they mark to targets by key, in one row each, and pass on what is marked already; a target gives one
    row for each text, with the number of its places.
    """

    def marks(at: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys, place = unbundled(rows)
        if at[0] >= buckets:
            return bundled(keys, place, targets_for(buckets))
        name = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["names"]])
        order = np.argsort(name)
        name, keys, place = name[order], keys[order], place[order]
        first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        sizes = np.diff(np.r_[first, len(name)])
        other = (keys != np.repeat(keys[first], sizes)) | (place != np.repeat(place[first], sizes))
        hit = np.repeat(np.logical_or.reduceat(other, first), sizes)
        if not hit.any():
            return pd.DataFrame(columns=["target", "keys", "counts", "gaps"])
        return bundled(keys[hit], place[hit], targets_for(buckets))

    def merged(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys, place = unbundled(rows)
        order = np.lexsort((place, keys))
        keys, place = keys[order], place[order]
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (place[1:] != place[:-1])]  # not twice from copies
        keys, place = keys[fresh], place[fresh]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        out = [(keys[a], b - a, gaps_of(place[a:b], np.zeros(1, np.int64))) for a, b in zip(first, np.r_[first[1:], len(keys)], strict=True)]
        return pd.DataFrame(out, columns=["k", "n", "places"])

    return names.groupBy("bucket").applyInPandas(marks, SENT).groupBy("target").applyInPandas(merged, PLACES)


def listed(raw: bytes) -> np.ndarray:
    """The places of one key."""
    return places_of(raw, np.array([(len(raw) - 1) // (2 if raw[:1] == b"2" else 4)]))


def runs(starts: np.ndarray, before: int, after: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The union of [s - before, s + after) over sorted starts, cut to [low, high), as begins and ends."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > before + after)
    begins = np.maximum(starts[np.r_[0, cut + 1]] - before, low)
    ends = np.minimum(starts[np.r_[cut, len(starts) - 1]] + after, high)
    keep = begins < ends
    return begins[keep], ends[keep]


def cut_out(raw: bytes, starts: np.ndarray, length: int) -> tuple[int, int, str]:
    """Removed bytes, maximal removed runs, SHA-256 of what is left."""
    begins, ends = runs(starts, 0, length, 0, len(raw))
    left, at = hashlib.sha256(), 0
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        left.update(raw[at:a])
        at = b
    left.update(raw[at:])
    return int((ends - begins).sum()), len(begins), left.hexdigest()


def sampled(docs: DataFrame, length: int) -> DataFrame:
    """k, n, places: texts (k, raw) that hold sampled suffixes whose prefix stands elsewhere too, how many and where.

    There is one at least in every text that holds a passage of passage_of(length) bytes that starts elsewhere too.
    """
    v, cover = cover_for(length)
    prefix = passage_of(length) - v + 1

    def names(row: dict) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(row["raw"], np.uint8)
        at = (np.arange(0, max(0, len(raw) - prefix + 1), v)[:, None] + cover).ravel()
        at = at[at <= len(raw) - prefix]
        return prefix_names(raw, at, prefix), at

    total = docs.agg(F.sum(F.octet_length("raw")).alias("n")).first()["n"] or 0
    buckets = max(16, total * len(cover) // v // BUCKET_NAMES)
    return repeated(packed(docs.filter(F.octet_length("raw") >= passage_of(length)).select("k", "raw"), buckets, names), buckets)


def with_texts(found: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """k, raw, places of found for texts of ``length`` bytes or more, one row for each text."""
    texts = docs.filter(F.octet_length("raw") >= length).select("k", "raw")
    if found.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(found.select("k")), "k", "left_semi")
    return texts.dropDuplicates(["k"]).join(found.select("k", "places").hint("shuffle_hash"), "k")


def marked(found: DataFrame, length: int) -> DataFrame:
    """k, n, places of all starts whose ``length`` bytes stand elsewhere too; found is with_texts()."""
    v, _ = cover_for(length)

    def near(row: dict) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(row["raw"], np.uint8)
        begins, ends = runs(listed(row["places"]), v - 1, 1, 0, len(raw) - length + 1)
        at = np.concatenate([np.arange(a, b) for a, b in zip(begins, ends, strict=True)]) if len(begins) else np.empty(0, np.int64)
        return prefix_names(raw, at, length), at

    total = found.agg(F.sum(F.octet_length("raw")).alias("n")).first()["n"] or 0
    buckets = max(16, total // BUCKET_NAMES)
    return repeated(packed(found, buckets, near), buckets)


def removed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared of every row.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same text or another;
    matches never cross texts and are judged on the input. n_shared tells of shorter passages too: the number of sampled
    starts at which a prefix stands that stands elsewhere too, above 0 wherever three quarters of ``length`` bytes do. Null
    texts are empty; repeated rows are copies of each other, so all of their bytes go if there are enough. Other columns
    aren't read.
    """
    states = States(docs.sparkSession, "suffixes")
    rows = docs.select("doc_id", text_of().cast("binary").alias("raw")).withColumn("k", F.xxhash64("raw"))
    found = states.save(sampled(rows, length), "sampled")
    texts = states.save(with_texts(found, rows, length), "texts")
    starts = states.save(marked(texts, length), "starts")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            made = [cut_out(x, listed(p), length) for x, p in zip(some["raw"], some["places"], strict=True)]
            yield pd.DataFrame({"k": some["k"], "n_removed": [x[0] for x in made], "n_spans": [x[1] for x in made], "kept": [x[2] for x in made]})

    cut = texts.select("k", "raw").join(starts.select("k", "places").hint("shuffle_hash"), "k").mapInPandas(each, "k long, n_removed long, n_spans long, kept string")
    copies = rows.groupBy("k").agg(F.count("*").alias("copies")).filter("copies > 1")
    facts = cut.unionByName(copies, True).unionByName(found.select("k", F.col("n").alias("n_shared")), True)
    facts = states.save(facts.groupBy("k").agg(*(F.max(c).alias(c) for c in ("n_removed", "n_spans", "kept", "copies", "n_shared"))), "facts")
    states.clear("texts", "starts", "sampled")
    small = facts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    plain = rows.select("doc_id", "k", F.octet_length("raw").cast("long").alias("n_bytes"), F.sha2("raw", 256).alias("whole"))
    out = plain.join(F.broadcast(facts) if small else facts, "k", "left")  # a text of very many rows is split by adaptive execution
    several, none, zero = F.col("copies") > 1, F.sha2(F.lit(b""), 256), F.lit(0).cast("long")
    gone = several & (F.col("n_bytes") >= length)  # a copy elsewhere: every string of it
    shared = F.coalesce("n_shared", zero)
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(gone, none).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
        F.when(several & (F.col("n_bytes") >= passage_of(length)), F.greatest(shared, F.lit(1).cast("long"))).otherwise(shared).alias("n_shared"),
    )
