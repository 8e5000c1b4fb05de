"""BPE encoding and decoding by dynamic programming over prefixes (operator 11).

Every prefix of a piece has one encoding, so it has one last token. An automaton
over all tokens gives the tokens that end at a position; of these exactly one
follows the last token of the prefix before it such that no merge would have
crossed the border between the two. That token is stored for the prefix, and
the ids of a piece are read back from its end. A piece of n bytes takes n steps,
each over the tokens that end there, and no merge is ever carried out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from prismcube.llm.word_bpe import byte_letters

#: Pieces of at most KEPT_BYTES bytes and pairs of tokens kept by each Python worker: bounds on its memory, not on the input.
KEPT_PIECES, KEPT_BYTES, KEPT_PAIRS = 200_000, 64, 300_000
#: Pieces held at once: a very long text needs no list of all its pieces.
AT_ONCE = 50_000
#: Characters of texts whose ids encode() hands out together, unless one text is longer.
CHARS_AT_ONCE = 1 << 20


class PrefixBpe:
    """Encoder and decoder over one byte-level tokenizer file. Files with settings that it doesn't know are refused."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added, split = spec["model"], spec["added_tokens"], spec["pre_tokenizer"]
        if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
            raise ValueError("a byte-level split without normaliser and prefix is needed")
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("the model has settings that plain merges don't cover")
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError("special tokens that take blanks or whole words aren't covered")
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        vocab: dict[str, int] = model["vocab"]
        self.size = max([*vocab.values(), *(x["id"] for x in added)]) + 1
        self.bytes_of: dict[int, bytes] = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        for x in added:
            name = x["content"]
            self.bytes_of[x["id"]] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        self.rank, self.left, self.right = [-1] * self.size, [-1] * self.size, [-1] * self.size
        self.merge: dict[int, int] = {}
        for at, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            i, j, made = vocab[a], vocab[b], vocab[a + b]
            if self.rank[made] >= 0 or len(a) > 1 and self.rank[i] < 0 or len(b) > 1 and self.rank[j] < 0:
                raise ValueError("each token must come from one merge of earlier ones")
            self.rank[made], self.left[made], self.right[made] = at, i, j
            self.merge[i * self.size + j] = at
        self.pattern = regex.compile(pattern)
        self.special = {x["content"]: x["id"] for x in added}
        names = sorted(self.special, key=len, reverse=True)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        # a token that its own bytes don't encode to is never the last of a prefix
        self.own: dict[bytes, int] = {}
        for t in sorted((i for t, i in vocab.items() if len(t) == 1 or self.rank[i] >= 0), key=self.rank.__getitem__):
            if self.rank[t] < 0 or self.bytes_of[self.left[t]] in self.own and self.bytes_of[self.right[t]] in self.own and self.apart(self.left[t], self.right[t], self.rank[t]):
                self.own[self.bytes_of[t]] = t
        if any(bytes([b]) not in self.own for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.length = {t: len(raw) for raw, t in self.own.items()}
        self.ending = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for raw, t in self.own.items():
            self.ending.add_word(raw.decode("latin-1"), t)
        self.ending.make_automaton()
        self.kept: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}

    def apart(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """Whether merges below the limit leave the border between a and b alone.

        The merges that made the two are taken back, the latest first; in between, the two symbols at the border must not be
        a pair that would have been merged before the merge just taken back. Of equal pairs the left one is merged first.
        """
        while True:
            crossing = self.merge.get(a * self.size + b)
            if crossing is not None and crossing < limit:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], self.right[a]
            elif self.rank[b] >= 0:
                limit, b = self.rank[b] + 1, self.left[b]
            else:
                return True

    def encode_piece(self, raw: bytes) -> list[int]:
        """The ids of one match of the split pattern."""
        if raw in self.own:
            return [self.own[raw]]
        length, fits, size = self.length, self.fits, self.size
        last, done = [0] * len(raw), -1
        for end, t in self.ending.iter(raw.decode("latin-1")):
            if end == done:
                continue  # its last token is known
            before = end - length[t]
            if before >= 0:
                pair = last[before] * size + t
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = self.apart(last[before], t)
                if not fit:
                    continue
            last[end], done = t, end
        ids, at = [], len(raw) - 1
        while at >= 0:
            ids.append(last[at])
            at -= length[last[at]]
        return ids[::-1]

    def coded(self, pieces: list[str]) -> bytes:
        """The ids of pieces as little-endian 32-bit integers."""
        kept, out = self.kept, {}
        for piece in set(pieces).difference(kept):
            raw = piece.encode("utf-8", "surrogatepass")
            (kept if len(raw) <= KEPT_BYTES else out)[piece] = np.array(self.encode_piece(raw), "<u4").tobytes()
        made = b"".join(map(kept.__getitem__, pieces)) if not out else b"".join([out[p] if p in out else kept[p] for p in pieces])
        if len(kept) > KEPT_PIECES:
            self.kept = {}
        if len(self.fits) > KEPT_PAIRS:
            self.fits = {}
        return made

    def stretches(self, text: str) -> Iterator[bytes]:
        """The coded ids of a text, some thousands of pieces at a time. Special strings in it are their one token."""
        for part in self.parts.split(text) if self.parts and any(x in text for x in self.special) else [text]:
            if part in self.special:
                yield np.array([self.special[part]], "<u4").tobytes()
            elif len(part) <= AT_ONCE:
                yield self.coded(self.pattern.findall(part))
            else:
                found = (m.group() for m in self.pattern.finditer(part))
                while some := list(islice(found, AT_ONCE)):
                    yield self.coded(some)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.stretches(text)), "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as 32-bit integers, SHA-256 of the decoded text in UTF-8."""
        n, ids_hash, back = 0, hashlib.sha256(), hashlib.sha256()
        for part in self.stretches(text):
            ids_hash.update(part)
            back.update(self.decode_bytes(np.frombuffer(part, "<u4")))  # pieces are whole characters, so their ids decode apart
            n += len(part) // 4
        return n, ids_hash.hexdigest(), back.hexdigest()


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> PrefixBpe:
    """One coder for each worker process."""
    return PrefixBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs and a column ``ids`` of array<int> (in place of one of that name): the ids of each whole text, a null one as empty.

    An empty text has no ids. Rows are independent, repeated rows give repeated results, an empty table an empty one. Texts
    are handed out again in groups of bounded size, whatever the size of Spark's batches.
    """
    docs = docs.drop("ids")
    schema = StructType([*docs.schema.fields, StructField("ids", ArrayType(IntegerType()))])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = coder(path, pattern)
        for rows in batches:
            held, some, start = 0, [], 0
            for at, x in enumerate(rows.pop("_text")):
                if some and held + len(x) > CHARS_AT_ONCE:
                    yield rows.iloc[start:at].assign(ids=some)
                    held, some, start = 0, [], at
                some.append(bpe.encode(x).astype(np.int32))
                held += len(x)
            if some:
                yield rows.iloc[start:].assign(ids=some)

    return docs.select("*", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).mapInPandas(each, schema)


def decode(coded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """coded and a column ``decoded`` of string: the text of the ids (null ids: empty; bytes that are no UTF-8: replaced).
    An id outside the vocabulary raises."""

    @F.pandas_udf("string")
    def to_text(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = coder(path, pattern)
        for some in rows:
            yield pd.Series(["" if x is None else bpe.decode(np.asarray(x)) for x in some], index=some.index, dtype=object)

    return coded.withColumn("decoded", to_text(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: encoded whole, decoded again, nothing kept in between.

    Nulls count as empty texts; an empty text has no ids and the digests of empty strings. Other columns, whatever
    their names, are not read. One row for each input row, an empty table gives an empty one.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = coder(path, pattern)
        for rows in batches:
            made = [bpe.digest(x or "") for x in rows["text"]]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "n_tokens": [x[0] for x in made], "ids_sha256": [x[1] for x in made], "decoded_sha256": [x[2] for x in made]})

    return docs.select("doc_id", "text").mapInPandas(each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
