"""Token counts under a word BPE vocabulary (operator 9): rank-synchronous array merging.

Distinct pieces of a batch of texts are held as one ragged numpy array of symbol
ids. Each round looks up the rank of every adjacent pair, takes the least rank
of each piece by a segmented minimum, and merges all places of that pair in all
pieces at once. Pieces without a ranked pair leave the array. What is left of a
piece is counted; counts of pieces add up to counts of texts.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

#: The byte-to-character table of byte-level vocabularies is this rule.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Pieces kept by each worker, and symbols merged at once: bounds on memory.
KEPT_PIECES, SYMBOLS_AT_ONCE = 300_000, 1_000_000
BIG = np.int64(1 << 60)


def byte_letters() -> list[str]:
    rest = iter(range(256, 512))
    return [chr(b) if b in PRINTED else chr(next(rest)) for b in range(256)]


class WordBpe:
    """The vocabulary of one tokenizer file, as far as counting needs it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.size = max(vocab.values()) + 1
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        letters, end = byte_letters(), model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + end] for x in letters], np.int64)
        split = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.split = regex.compile(split)
        special = [x["content"] for x in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.kept: dict[str, int] = {}

    def normal(self, text: str) -> str:
        """NFC, then lower case letter by letter (no rule for a final sigma). Blanks part pieces however many they are, so they stay."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pieces of a text, and how many special tokens stand between them."""
        if self.special is None or "<|" not in text:
            return self.split.findall(self.normal(text)), 0
        parts = self.special.split(text)
        return [p for x in parts for p in self.split.findall(self.normal(x))], len(parts) - 1

    def merged(self, pieces: list[str]) -> np.ndarray:
        """The number of symbols of each piece after all merges."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        sizes = np.array([len(x) for x in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym, last = self.inner[flat], np.cumsum(sizes) - 1
        sym[last] = self.last[flat[last]]
        counts, live, owner = sizes.copy(), np.arange(len(raw)), np.repeat(np.arange(len(raw)), sizes)
        while len(sym) > 1:
            pair = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & (owner[:-1] == owner[1:]), self.ranks[at], BIG)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rank = np.r_[rank, BIG]
            least = np.minimum.reduceat(rank, first)
            lengths = np.diff(np.r_[first, len(sym)])
            hit = (rank == np.repeat(least, lengths)) & (rank < BIG)
            # of overlapping places (a a a) every second one, from the left
            run = np.flatnonzero(hit)
            if len(run):
                start = np.r_[True, np.diff(run) != 1]
                nth = np.arange(len(run)) - np.maximum.accumulate(np.where(start, np.arange(len(run)), 0))
                run = run[nth % 2 == 0]
            done = least == BIG
            sym[run] = self.made[rank[run]]
            keep = np.ones(len(sym), bool)
            keep[run + 1] = False
            counts[live[done]] = lengths[done]
            keep &= ~np.repeat(done, lengths)
            if not keep.any():
                return counts
            renamed = np.cumsum(~done) - 1
            local = np.repeat(renamed, lengths)[keep]
            sym, owner, live = sym[keep], local, live[~done]
        counts[live] = 1
        return counts

    def learn(self, pieces: list[str], counts: dict[str, int]) -> None:
        """Put the counts of new pieces, batch by batch; short ones by order of length, so that rounds end together."""
        pieces.sort(key=len)
        batch, held = [], 0
        for p in [*pieces, None]:
            if batch and (p is None or held + len(p) > SYMBOLS_AT_ONCE):
                counts.update(zip(batch, self.merged(batch).tolist(), strict=True))
                batch, held = [], 0
            if p is not None:
                batch.append(p)
                held += len(p)

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pieces(x) for x in texts]
        if len(self.kept) > KEPT_PIECES:
            self.kept = {}
        new = {p for own, _ in split for p in own}.difference(self.kept)
        counts = self.kept
        self.learn(list(new), counts)
        return [sum(map(counts.__getitem__, own)) + extra for own, extra in split]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, at_once: int = 4_000_000) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text; a null text counts as empty.

    Special strings inside a text count as one token each, as the library does by default. at_once bounds the characters
    whose pieces are held together (a longer text is held alone). One row for each input row; other columns aren't read.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = vocabulary(path)
        for rows in batches:
            texts = [x or "" for x in rows["text"]]
            counts: list[int] = []
            some: list[str] = []
            held = 0
            for x in texts:
                if some and held + len(x) > at_once:
                    counts += bpe.count(some)
                    some, held = [], 0
                some.append(x)
                held += len(x)
            counts += bpe.count(some) if some else []
            out = pd.DataFrame({"doc_id": rows["doc_id"], "n_bytes": [len(x.encode("utf-8", "surrogatepass")) for x in texts], "n_tokens": counts})
            yield out.assign(over_limit=out["n_tokens"] > limit)

    return docs.select("doc_id", "text").mapInPandas(each, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
