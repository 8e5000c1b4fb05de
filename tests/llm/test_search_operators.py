"""Operators 11 to 13 against the library, SQL and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from prismcube.llm import lexical, negatives, prefix_bpe, queries
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"
BPE, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ODD = [None, "", " \n\t ", "a", "x" * 3000, "aaa aaa", "word " * 400, "é ü 日本 🙂   z \x00\x1c\x85", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endof", "don't DON'T 12345 6\n\n 7", "same", "same"]


@pytest.fixture(scope="module")
def odd(spark):
    data = [(i, t, 1, "n", 2) for i, t in enumerate(ODD)] + [(None, "no id", 1, "n", 2), (3, "a", 1, "n", 2)]
    return spark.createDataFrame(data, "doc_id long, text string, ids int, tf string, n long")


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# --- 11 --------------------------------------------------------------------------------------------------------------


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_bpe_equals_library(spark, request, which):
    df = request.getfixturevalue("odd") if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    own, expected = library(), []
    for d, t in texts(df):
        ids = own.encode(t, add_special_tokens=False).ids
        back = own.decode(ids, skip_special_tokens=False)
        expected.append((d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = prefix_bpe.digests(df, BPE, PATTERN)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert prefix_bpe.digests(df.filter(F.lit(False)), BPE, PATTERN).count() == 0


def test_bpe_random_texts():
    own, mine, rnd = library(), prefix_bpe.coder(BPE, PATTERN), random.Random(5)
    letters = "abcdeINGing '0123sdtv\n\té日🙂<|>-=_"
    for _ in range(800):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(200)))
        ids = own.encode(text, add_special_tokens=False).ids
        assert mine.encode(text).tolist() == ids
        assert mine.decode(mine.encode(text)) == own.decode(ids, skip_special_tokens=False)


def test_bpe_equals_plain_merging():
    """Merging the pair of least rank, the leftmost first, gives the same tokens on pieces of few letters (many ties)."""
    mine, rnd = prefix_bpe.coder(BPE, PATTERN), random.Random(6)
    for _ in range(400):
        raw = bytes(rnd.choice(b"aehnt") for _ in range(rnd.randrange(1, 60)))
        ids = [mine.own[bytes([b])] for b in raw]
        while len(ids) > 1:
            rank, at = min((mine.merge.get(a * mine.size + b, 1 << 60), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
            if rank == 1 << 60:
                break
            ids[at : at + 2] = [mine.own[mine.bytes_of[ids[at]] + mine.bytes_of[ids[at + 1]]]]
        assert mine.encode_piece(raw) == ids


def test_bpe_long_text_and_batches(spark, monkeypatch):
    rnd, own = random.Random(7), library()
    long = "".join(rnd.choice(["ab ", "Cde", " 1234", "é!", "x" * 70, "<|endoftext|>"]) for _ in range(60_000))
    df = spark.createDataFrame([(1, long, 1), (2, None, 1), (3, "short", 1), (3, "short", 1), (4, long[1:], 1)], "doc_id long, text string, ids int").coalesce(1)
    got = prefix_bpe.encode(df, BPE, PATTERN)
    assert got.columns == ["doc_id", "text", "ids"]
    for r in prefix_bpe.decode(got, BPE, PATTERN).collect():
        assert r["ids"] == own.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")


def test_bpe_refuses_other_files(tmp_path):
    import json

    with open(BPE, encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"model": {**spec["model"], "ignore_merges": True}}, {"model": {**spec["model"], "merges": [*spec["model"]["merges"], spec["model"]["merges"][0]]}}):
        at = tmp_path / "other.json"
        at.write_text(json.dumps({**spec, **change}), encoding="utf-8")
        with pytest.raises(ValueError):
            prefix_bpe.PrefixBpe(str(at), PATTERN)


# --- 12 --------------------------------------------------------------------------------------------------------------


def brute_search(docs, items, k=10):
    found = lambda t: re.findall(lexical.TERM, (t or "").translate(str.maketrans(lexical.A_TO_Z, lexical.LOWER)))
    held = [(d, Counter(found(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(found(t))
    out = []
    for i, terms in own.items():
        scores = []
        for d, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def test_search_equals_sql(spark):
    got = queries.QUERIES["op12_lexical_search"](spark, SF).toPandas()
    assert rows(got) == rows(connect(SF).sql(queries.ORACLES["op12_lexical_search"]).df())


def test_search_odd_rows(spark, odd):
    """Nulls, guards beside each other, terms within terms, letters beyond ASCII, ties, repeated documents and items."""
    more = [(100 + i, t, 1, "n", 2) for i, t in enumerate(["a,a;a a", "aa a_a É é", "É日本É", "a" * 5000 + " word", "WORD Word", " x  x", "x\x00y z", "tie one", "tie one", "tie one"])]
    docs = odd.unionByName(spark.createDataFrame(more + [(107, "tie one", 1, "n", 2)], odd.schema))
    items = [(1, "A word"), (2, None), (3, ""), (4, "é 日本 É日本É"), (5, "tie tie TIE"), (5, "one"), (None, "x y"), (6, "nowhere_at all"), (7, " x ")]
    df = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    expected = brute_search(texts(docs), items)
    for at_once in (lexical.AUTOMATON_BYTES, 8):  # in one scan, and in several
        assert sorted(map(tuple, lexical.ranked(docs, df, at_once=at_once).collect()), key=str) == expected
    assert sorted(map(tuple, lexical.ranked(docs, df, k=2).collect()), key=str) == brute_search(texts(docs), items, 2)


def test_search_many_ties_over_tasks(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "left right").otherwise("left left up").alias("text")).repartition(9)
    items = spark.createDataFrame([("a", "left"), ("b", "right up")], "item_id string, text string")
    assert sorted(map(tuple, lexical.ranked(docs, items).collect()), key=str) == brute_search(texts(docs), [("a", "left"), ("b", "right up")])


def test_search_empty(spark, odd):
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    for d, i in ((odd.filter("false"), items), (odd, items.filter("false")), (odd.filter("doc_id < 3"), items)):
        got = lexical.ranked(d, i)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


# --- 13 --------------------------------------------------------------------------------------------------------------


def brute_negatives(data, every=100):
    fine = []
    for v, x, label in data:
        if v is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        fine.append((v, (label + 1) % 10 if v % 7 == 0 else label, [math.floor(256 * np.float32(c).astype(float)) for c in x]))
    out = []
    for a, la, xa in {(v, label, tuple(x)) for v, label, x in fine if v % every == 0}:
        scored = sorted((-sum(p * q for p, q in zip(xa, x, strict=False)), v, label) for v, label, x in fine if v != a)
        same = [s for s in scored if s[2] == la][:5]
        for s, p, _ in same:
            inside = [x for x in scored if x[2] != la and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, r, x[1], -s, -x[0]) for r, x in enumerate(inside, 1)]
    return sorted(out)


def test_negatives_equal_sql(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        got = queries.QUERIES["op13_hard_negatives"](spark, sf).toPandas()
        assert len(got) and rows(got) == rows(connect(sf).sql(queries.ORACLES["op13_hard_negatives"]).df())


def vectors(spark, data):
    return spark.createDataFrame([(v, x, label, "n", 1) for v, x, label in data], "vec_id long, embedding array<float>, label int, rank string, anchor int")


@pytest.mark.parametrize("kind", ["spread", "tied", "one label"])
def test_negatives_equal_brute_force(spark, kind):
    """Small blocks and rounds, several tasks; ties, negative and zero scores, odd rows and lengths."""
    rnd = random.Random(len(kind))
    pick = (lambda: rnd.choice([0.0, 0.5, -0.5])) if kind == "tied" else (lambda: rnd.gauss(0, 1))
    data = [(i, [pick() for _ in range(6)], 3 if kind == "one label" and i % 3 else rnd.randrange(4)) for i in range(900)]
    data += [(10_000, None, 1), (10_100, [1.0, None], 1), (10_200, [float("nan")] * 6, 2), (10_300, [float("inf")] * 6, 2), (10_400, [1.0] * 6, None), (None, [1.0] * 6, 1), (10_500, [], 1), (10_600, [1.0, 2.0], 1), (10_601, [1.0] * 9, 0)]
    data += [data[0], data[0], data[5]]
    df = vectors(spark, data).repartition(5)
    got = negatives.mined(df, every=10, block=7, at_once=2000)
    assert sorted(map(tuple, got.collect())) == brute_negatives(data, 10)


def test_negatives_large_values(spark):
    rnd = random.Random(3)
    data = [(i, [float(rnd.randrange(-(1 << 20), 1 << 20)) for _ in range(3)], rnd.randrange(2)) for i in range(60)]
    assert sorted(map(tuple, negatives.mined(vectors(spark, data), every=10).collect())) == brute_negatives(data, 10)


def test_negatives_empty(spark):
    got = negatives.mined(vectors(spark, [(1, [1.0], 1), (100, None, 1)]))
    assert got.count() == 0 and len(got.columns) == 6
    assert negatives.mined(vectors(spark, [(1, [1.0], 1)]).filter("false")).count() == 0
    assert negatives.mined(vectors(spark, [(100, [1.0], 1), (101, [1.0], 2)])).count() == 0  # no positive


def test_tree_bounds_spare_scores():
    """On anchors and rows in tight groups most scores are never computed, and bounds hold along the tree."""
    rnd = np.random.default_rng(4)
    middles = rnd.normal(0, 200, (12, 16))
    place = lambda n: np.floor(middles[rnd.integers(0, 12, n)] + rnd.normal(0, 4, (n, 16)))
    anchors, rows_ = place(200), place(2000)
    order, parent, edge = negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(200)) and (parent < np.arange(200)).all()
    assert np.allclose(edge[1:], negatives.norms(anchors[order][1:] - anchors[order][parent[1:]]))
    block = negatives.Block(0, 0, np.arange(200), anchors[order], parent, edge)
    exact = rows_ @ block.vecs.T
    asked = {i: [negatives.Found(5, -np.inf, np.inf)] for i in range(200)}
    for low in range(0, 2000, 250):
        ids = np.arange(1000 + low, 1250 + low)
        done = negatives.walk(block, ids, rows_[low : low + 250], asked.__getitem__)
    assert done < 0.5 * 200 * 250
    for i in range(200):
        assert asked[i][0].scores.tolist() == sorted(exact[:, i].tolist(), reverse=True)[:5]
