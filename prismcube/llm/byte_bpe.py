"""Byte-level BPE: encode and decode whole texts (operator 3).

Each match of the split pattern is merged on its own. A segment tree over the
byte positions of a piece holds, for every live symbol, the rank of the pair
that it starts; the root gives the leftmost pair of least rank. A merge updates
the two live neighbours only, so a piece of n bytes costs O(n log n) however
long it is. Pieces repeat, so each Python worker keeps a bounded table of
finished ones; a miss is merged again, the results are the same.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from prismcube.llm.common import tidy

#: Pieces of at most 64 bytes kept by each Python worker: a bound on its memory, not on the input.
KEPT_PIECES = 100_000
#: Matches, and texts of no more characters than that, handled at once: a very long text needs no list of all its pieces.
AT_ONCE, TEXTS_AT_ONCE = 50_000, 1_000
#: Pieces whose trees are rows of one array.
MERGED_AT_ONCE = 5_000
#: Bytes of texts that encode() hands out together, unless one text is longer.
BYTES_AT_ONCE = 1 << 20


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (x.split() for x in lines if x.strip())}


class PairTree:
    """Least (rank, position) over byte positions; a position without a pair holds ``none``."""

    def __init__(self, keys: list[int], none: int):
        self.size = 1 << max(1, (len(keys) - 1).bit_length())
        self.tree = [none] * self.size + keys + [none] * (self.size - len(keys))
        for i in range(self.size - 1, 0, -1):
            left, right = self.tree[2 * i], self.tree[2 * i + 1]
            self.tree[i] = left if left <= right else right

    def put(self, at: int, key: int) -> None:
        tree, i = self.tree, at + self.size
        tree[i] = key
        while i > 1:
            i >>= 1
            left, right = tree[2 * i], tree[2 * i + 1]
            least = left if left <= right else right
            if tree[i] == least:
                break
            tree[i] = least

    def least(self) -> int:
        return self.tree[1]


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    none = len(ranks) * 2 * n + n  # above every key rank * n + position
    none = max(none, (max(ranks.values(), default=0) + 1) * n + n)
    rank_of = ranks.get

    def key(start: int, end: int) -> int:
        rank = rank_of(piece[start:end])
        return none if rank is None else rank * n + start

    ends = list(range(1, n + 1))  # of the symbol that starts at a position
    before = list(range(-1, n - 1))  # start of the live symbol before it
    tree = PairTree([key(i, i + 2) for i in range(n - 1)] + [none], none)
    while (best := tree.least()) != none:
        at = best % n
        gone = ends[at]
        end = ends[at] = ends[gone]
        tree.put(gone, none)
        if end < n:
            before[end] = at
            tree.put(at, key(at, ends[end]))
        else:
            tree.put(at, none)
        if (left := before[at]) >= 0:
            tree.put(left, key(left, end))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return ids


class PairTable:
    """For two adjacent symbols, by ids: the id (which is the rank) of the symbol they merge to; ``none`` if they don't."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values()) + 1
        pairs = [(ranks[x[:i]] * self.none + ranks[x[i:]], r) for x, r in ranks.items() for i in range(1, len(x)) if x[:i] in ranks and x[i:] in ranks]
        keys, made = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        order = np.argsort(keys)
        self.keys, self.made = np.append(keys[order], np.int64(1 << 62)), np.append(made[order], self.none)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.bytes = self.merge(np.repeat(self.single, 256), np.tile(self.single, 256))

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.none + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], self.none)


def merge_batch(pieces: list[bytes], table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """The ids of pieces of 2 to 64 bytes, and how many each has: one segment tree for each, all trees as rows of one array.

    A step takes every root's leftmost least pair, merges it, and repairs the paths above the positions whose pairs changed.
    """
    n, sizes = len(pieces), np.array([len(x) for x in pieces], np.int64)
    width = 1 << int(sizes.max() - 1).bit_length()
    place, shift = np.arange(width), width.bit_length() - 1
    live = place < sizes[:, None]
    raw = np.zeros((n, width), np.int64)
    raw[live] = np.frombuffer(b"".join(pieces), np.uint8)
    none = np.int32((table.none << shift) | (width - 1))
    tree = np.full((n, 2 * width), none, np.int32)
    first = table.bytes[raw[:, :-1] * 256 + raw[:, 1:]]
    tree[:, width : 2 * width - 1] = np.where((first != table.none) & live[:, 1:], (first << shift) | place[:-1], none)
    for level in range(shift - 1, -1, -1):
        w = 1 << level
        tree[:, w : 2 * w] = np.minimum(tree[:, 2 * w : 4 * w : 2], tree[:, 2 * w + 1 : 4 * w : 2])
    # All arrays are flat from here: position p of row r is r * width + p, its leaf r * 2 * width + width + p.
    symbol = table.single[raw].ravel()
    after = np.where(place + 1 < sizes[:, None], place + 1, width).astype(np.int32).ravel()  # the next live symbol; width: none
    before = np.tile((place - 1).astype(np.int32), n)
    live, tree = live.ravel(), tree.ravel()
    rows = np.flatnonzero(tree[1 :: 2 * width] != none)

    def put(base: np.ndarray, at: np.ndarray, key: np.ndarray) -> None:
        node = at + width
        tree[base + node] = key
        for _ in range(shift):
            pair = base + (node & ~1)
            node = node >> 1
            tree[base + node] = np.minimum(tree[pair], tree[pair + 1])

    while len(rows):
        base, row = rows * (2 * width), rows * width
        best = tree[base + 1].astype(np.int64)
        at = best & (width - 1)
        here = row + at
        gone = after[here].astype(np.int64)
        end = after[row + gone].astype(np.int64)
        symbol[here] = best >> shift
        after[here] = end
        live[row + gone] = False
        tree[base + width + gone] = none  # its path is repaired below
        has = end < width
        key = np.full(len(rows), none, np.int32)
        there = (row + end)[has]
        before[there] = at[has]
        made = table.merge(symbol[here[has]], symbol[there])
        key[has] = np.where(made < table.none, (made << shift) | at[has], none)
        tree[base + width + at] = key
        left = before[here].astype(np.int64)
        has = left >= 0
        b, l = base[has], left[has]
        made = table.merge(symbol[row[has] + l], symbol[here[has]])
        tree[b + width + l] = np.where(made < table.none, (made << shift) | l, none)
        put(base, gone, none)
        apart = (gone ^ at) > 1  # siblings have one path
        put(base[apart], at[apart], key[apart])
        apart = has & ((left ^ at) > 1) & ((left ^ gone) > 1)
        put(base[apart], left[apart], tree[base[apart] + width + left[apart]])
        rows = rows[tree[base + 1] != none]
    return symbol[live], live.reshape(n, width).sum(axis=1)


class ByteBpe:
    """Encoder and decoder over one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.table = ranks, regex.compile(pattern), PairTable(ranks)
        self.bytes_of = {rank: piece for piece, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.bytes_of}
        self.kept: dict[str, tuple[int, ...]] = {}
        self.long: list[str] = []

    def learn(self, pieces: list[str]) -> None:
        """Put new pieces in the table: whole ones at once, short ones in batches of like length, long ones each by its own tree."""
        short: dict[int, list[tuple[bytes, str]]] = {8: [], 16: [], 32: [], 64: []}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            if (whole := self.ranks.get(raw)) is not None:
                self.kept[piece] = (whole,)
            elif (n := len(raw)) <= 64:
                short[8 if n <= 8 else 16 if n <= 16 else 32 if n <= 32 else 64].append((raw, piece))
            else:
                self.kept[piece] = tuple(merge_piece(raw, self.ranks))
                self.long.append(piece)
        for some in short.values():
            for i in range(0, len(some), MERGED_AT_ONCE):
                raws, names = zip(*some[i : i + MERGED_AT_ONCE], strict=True)
                ids, counts = merge_batch(raws, self.table)
                ids = iter(ids.tolist())
                self.kept.update(zip(names, (tuple(islice(ids, n)) for n in counts.tolist()), strict=True))

    def ids_of(self, pieces: list[str]) -> Iterator[int]:
        """The ids of pieces that learn() has seen since the last forget()."""
        return chain.from_iterable(map(self.kept.__getitem__, pieces))

    def forget(self) -> None:
        """Keep the table within its bounds."""
        for piece in self.long:
            self.kept.pop(piece, None)
        self.long = []
        if len(self.kept) > KEPT_PIECES:
            self.kept = {}

    def parts(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, some thousands of pieces at a time."""
        found = iter(self.pattern.findall(text) if len(text) <= AT_ONCE else (m.group() for m in self.pattern.finditer(text)))
        while some := list(islice(found, AT_ONCE)):
            self.learn(list(set(some).difference(self.kept)))
            yield list(self.ids_of(some))
            self.forget()

    def encode(self, text: str) -> list[int]:
        return [x for part in self.parts(text) for x in part]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids joined by a space, SHA-256 of the bytes the ids decode to."""
        n, ids_hash, back_hash = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.parts(text):
            ids_hash.update(((" " if n else "") + " ".join(map(self.names.__getitem__, ids))).encode())
            back_hash.update(self.decode_bytes(ids))
            n += len(ids)
        return n, ids_hash.hexdigest(), back_hash.hexdigest()

    def batches(self, texts: list[str]) -> Iterator[list[tuple[str, list[int] | None]]]:
        """Texts with their ids, some hundreds at a time, the new pieces of all short ones merged together; long ones get None."""
        for i in range(0, len(texts), TEXTS_AT_ONCE):
            some = texts[i : i + TEXTS_AT_ONCE]
            split = [self.pattern.findall(x) if len(x) <= AT_ONCE else None for x in some]
            self.learn(list(set().union(*filter(None, split)).difference(self.kept)))
            made = [(x, None if own is None else list(self.ids_of(own))) for x, own in zip(some, split, strict=True)]
            self.forget()
            yield made

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """encode() of many texts."""
        return [np.array(self.encode(x) if ids is None else ids, np.int32) for some in self.batches(texts) for x, ids in some]

    def digest_all(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """digest() of many texts."""

        def one(ids: list[int]) -> tuple[int, str, str]:
            return len(ids), hashlib.sha256(" ".join(map(self.names.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(self.decode_bytes(ids)).hexdigest()

        return [self.digest(x) if ids is None else one(ids) for some in self.batches(texts) for x, ids in some]


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """One coder for each worker process."""
    return ByteBpe(load_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """docs and a column ``ids`` of array<int> (in place of one of that name): the ids of each whole text, a null one as empty.

    An empty text has no ids. Rows are independent: repeated rows give repeated results. Without keep_text the texts aren't
    returned. Few texts are held at once, whatever the size of Spark's batches.
    """
    docs = docs.drop("ids")
    kept = [c for c in docs.columns if keep_text or c != text]
    schema = StructType([*(f for f in docs.schema.fields if f.name in kept), StructField("ids", ArrayType(IntegerType()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            texts = batch.column(len(kept)).fill_null("")
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            low = 0
            while low < len(texts):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + BYTES_AT_ONCE, "right")))
                made = bpe.encode_all(texts[low:high].to_pylist())
                places = np.cumsum([0, *map(len, made)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(made)))
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[low:high] for i in range(len(kept))), ids], [*kept, "ids"])
                low = high
        bpe.kept = {}

    return docs.select(*kept, F.col(text).cast("string").alias("_text")).mapInArrow(tidy(each), schema)


def decode(coded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """coded and a column ``decoded`` of binary: the bytes of the ids (null ids: no bytes). An id outside the vocabulary raises."""

    @F.pandas_udf("binary")
    def to_bytes(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = coder(path, pattern)
        for some in rows:
            yield pd.Series([b"" if x is None else bpe.decode_bytes(list(x)) for x in some], index=some.index, dtype=object)

    return coded.withColumn("decoded", to_bytes(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: encoded whole, decoded again, nothing kept in between.

    Nulls count as empty texts; an empty text has no ids and the digests of empty strings. Other columns, whatever
    their names, are not read. One row for each input row, an empty table gives an empty one.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = coder(path, pattern)
        for rows in batches:
            made = bpe.digest_all([x or "" for x in rows["text"]])
            yield pd.DataFrame({"doc_id": rows["doc_id"], "n_tokens": [x[0] for x in made], "ids_sha256": [x[1] for x in made], "decoded_sha256": [x[2] for x in made]})

    return docs.select("doc_id", "text").mapInPandas(each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
