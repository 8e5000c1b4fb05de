"""Corpus operators against brute force on small tables with odd rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from prismcube.llm import byte_bpe, decontaminate, parity_join, pii, quality, queries, secrets, suffix_dedup, url_filter, warc, word_bpe
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"
RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
#: Null, empty, blank, tied, repeated and odd texts; the further columns clash with names that operators make.
ODD = [None, "", " \n\t ", "a", "one two three four", "x" * 3000, "word " * 400, "aaa aaa", "é ü 日本 🙂 \u00a0 z", "\ue000 \ue001 \ue010 token=\ue000abcdef12", "same text here again", "same text here again", "l1 a\nl1 a\nl2\n\n \nl1 a"]


@pytest.fixture(scope="module")
def odd(spark):
    data = [(i, t, "n", "c", i) for i, t in enumerate(ODD)] + [(None, "no id at all", "n", "c", 0), (10, "same text here again", "n", "c", 0)]
    df = spark.createDataFrame(data, "doc_id long, text string, kept string, cls string, n_chars long")
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def none(df):
    return df.filter(F.lit(False))


def by_id(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- 3 and 9: tokens -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_byte_bpe_equals_library(request, which):
    import tiktoken

    df = request.getfixturevalue(which)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    expected = []
    for d, t in texts(df):
        ids = own.encode_ordinary(t)
        expected.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert by_id(byte_bpe.digests(df, RANKS, public_tokenizers.PATTERN)) == sorted(expected, key=str)
    assert byte_bpe.digests(none(df), RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_round_trip(odd):
    coded = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    for r in byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "")


def test_long_texts_in_small_batches(spark, monkeypatch):
    """A text of more pieces than are handled at once, handed out with short and null ones; a column named ids is replaced."""
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    rnd = random.Random(12)
    long = " ".join(rnd.choice(["ab", "Cde", "1234", "é!", "x" * 70]) for _ in range(120_000))
    data = [(1, long, 1), (2, None, 1), (3, "short", 1), (3, "short", 1), (4, long + "end", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, ids int").coalesce(1)
    got = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, keep_text=False)
    assert got.columns == ["doc_id", "ids"]
    assert [(r["doc_id"], r["ids"]) for r in got.orderBy("doc_id").collect()] == [(d, own.encode_ordinary(x or "")) for d, x, _ in data]
    bpe = byte_bpe.coder(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 100)
    ids = own.encode_ordinary(long[:5000])
    assert bpe.encode(long[:5000]) == ids and bpe.digest(long[:5000])[0] == len(ids)


def test_segment_tree_on_long_pieces():
    import tiktoken

    ranks = byte_bpe.load_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(4)
    for n in (65, 300, 4000):
        for letters in ("a", "ab", "etaoinshr"):
            piece = "".join(rnd.choice(letters) for _ in range(n))
            assert byte_bpe.merge_piece(piece.encode(), ranks) == own.encode_ordinary(piece)


def test_ranks_file_is_read_whole():
    with open(RANKS, "rb") as f:
        assert len(byte_bpe.load_ranks(RANKS)) == sum(1 for x in f if x.strip())
    assert byte_bpe.load_ranks(RANKS)[base64.b64decode(b"IQ==")] >= 0


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_word_counts_equal_library(request, which):
    from tokenizers import Tokenizer

    df, own = request.getfixturevalue(which), Tokenizer.from_file(WORDS)
    expected = []
    for d, t in texts(df):
        n = len(own.encode(t, add_special_tokens=False).ids)
        expected.append((d, len(t.encode()), n, n > 2048))
    assert by_id(word_bpe.count_tokens(df, WORDS)) == sorted(expected, key=str)


def test_word_counts_with_special_strings(spark):
    from tokenizers import Tokenizer

    own, odd = Tokenizer.from_file(WORDS), ["<|endoftext|>x<|startoftext|><|endoftext|>", "İ ΑΣ ﬁ ǅ Don'T", "a" * 5000, "aab" * 700]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    assert [r["n_tokens"] for r in word_bpe.count_tokens(df, WORDS).orderBy("doc_id").collect()] == [len(own.encode(t, add_special_tokens=False).ids) for t in odd]


# --- 2: personal data ------------------------------------------------------------------------------------------------

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(t):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = [True, k != 1 or all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(d) <= 19 and pii.luhn(d), 9 <= len(d) <= 15][k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_patterns():
    rnd = random.Random(2)
    for _ in range(5000):
        t = "".join(rnd.choice("a1@.+- ()90%4é") for _ in range(40))
        assert pii.base_spans(t) == brute_pii(t)


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_pii_report(request, which):
    df = request.getfixturevalue(which)
    expected = {}
    for d, t in texts(df):
        base = brute_pii(t)
        named = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        expected[d] = (*(sum(x[1] == k for x in base) for k in range(4)), hashlib.sha256(named.encode()).hexdigest(), {x for x in named.split(",") if x})
    out = pii.report(df).collect()
    assert len(out) == df.count()
    for r in out:
        *same, own = expected[r["doc_id"]]
        assert [r[c] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256")] == same
        assert own <= {*r["spans"].split(",")} | {""}
    assert pii.report(none(df)).count() == 0


def test_skip_edges_carry_a_label_to_a_bare_repeat(spark):
    rnd = random.Random(5)
    number = lambda: f"({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"
    numbers = [number() for _ in range(200)]
    train = [(i, f"call +1 {n} now, item {rnd.randrange(10, 99)} of 4.0 or later +1 {n} again") for i, n in enumerate(numbers)]
    n = number()
    probe = [(900, f"call +1 {n} now. Much later, the desk {n} again"), (901, "the room 12 of 4.0 is free")]
    field = pii.fit(spark.createDataFrame(train, "doc_id long, text string"))
    assert field.skip > 0
    got = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(probe, "doc_id long, text string"), field).collect()}
    assert got[900].startswith("phone:") and "field_phone" in got[900] and got[901] == ""


def test_a_value_is_known_at_all_its_repeats(spark):
    rnd = random.Random(6)
    numbers = [f"({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}" for _ in range(200)]
    train = [(i, f"call +1 {n} now, item {rnd.randrange(10, 99)} of 4.0 or later +1 {n} again") for i, n in enumerate(numbers)]
    field = pii.fit(spark.createDataFrame(train, "doc_id long, text string"))
    n = numbers[0]
    probe = f"call +1 {n} now." + f" Much later, the desk {n} again." * 50
    (row,) = pii.report(spark.createDataFrame([(1, probe)], "doc_id long, text string"), field).collect()
    assert row["n_phone"] == 1 and row["spans"].count("field_phone") == 50


# --- 4: repeated strings ---------------------------------------------------------------------------------------------


def brute_removed(data, length):
    seen = {}
    for _, t in data:
        b = t.encode()
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for d, t in data:
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, y in zip(b, gone, strict=True) if not y)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("which", "length"), [("odd", 20), ("odd", 3), ("docs", 400), ("docs", 60)])
def test_repeated_strings(request, which, length):
    df = request.getfixturevalue(which)
    out = suffix_dedup.removed(df, length).cache()
    assert by_id(out.drop("n_shared")) == brute_removed(texts(df), length)
    passages = {r[0] for r in brute_removed(texts(df), suffix_dedup.passage_of(length)) if r[2]}
    assert passages <= {r["doc_id"] for r in out.filter("n_shared > 0").collect()}
    assert suffix_dedup.removed(none(df), length).count() == 0


def test_a_hot_passage_is_sent_once_by_each_batch():
    """Names that stand several times in a batch are marked there; the bucket gets one of their places."""
    import numpy as np

    packer = suffix_dedup.Packer(2, 4)
    for key in range(1, 101):
        packer.add(key, np.array([7, key * 1000], np.uint64), np.array([5, 9]))
    out = packer.rows()
    sent, marked = out[out["bucket"] < 2], out[out["bucket"] >= 2]
    assert sum(len(x) // 8 for x in sent["names"]) == 101
    keys, places = suffix_dedup.unbundled(marked)
    assert sorted(keys.tolist()) == [*range(1, 101)] and {*places.tolist()} == {5}


def test_names_of_starts_far_apart(monkeypatch):
    import numpy as np

    raw = np.frombuffer(bytes(random.Random(13).randrange(97, 99) for _ in range(5000)), np.uint8)
    starts = np.r_[np.arange(0, 300), np.arange(2000, 2010), np.arange(4700, 4990)]
    whole = suffix_dedup.prefix_names(raw, starts, 10)
    same = {}
    for s, n in zip(starts.tolist(), whole.tolist(), strict=True):
        assert same.setdefault(raw[s : s + 10].tobytes(), n) == n
    assert len({*same.values()}) == len(same)
    monkeypatch.setattr(suffix_dedup, "STARTS_AT_ONCE", 64)
    assert np.array_equal(suffix_dedup.prefix_names(raw, starts, 10), whole)


def test_covers_are_difference_covers():
    for v, cover in suffix_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == {*range(v)}


def test_field_fitted_on_documents_finds_repeats_and_no_look_alikes(spark, docs, monkeypatch):
    """The field of the given documents: repeats of found values in other forms are found, look-alikes aren't; texts don't affect each other."""
    field = pii.fit(docs)
    said = "Call +1 (212) 555-1234 today, or ring 212 555-1234 or 2125551234 when late. ref 2125551234 again, order 9988776655 twice 9988776655"
    (row,) = pii.find([said], field)
    assert row[5] == "phone:5:22,field_phone:42:50,field_phone:54:64,field_phone:80:90" and row[7]
    rnd, tries, hits, false = random.Random(3), 0, 0, 0
    for _, text in texts(docs):
        for start, kind, end in pii.base_spans(text)[:1]:
            other = pii.disguised(kind, text[start:end])
            if pii.form(other) is None or pii.base_spans(other):
                continue
            fake = "".join(rnd.choice("123456789") if c.isdigit() else c for c in other) if kind else "x" + other
            new = f"{text} said again {other} or then {fake} and so {fake} end"
            at = len(text) + 12
            found = [tuple(map(int, x.split(":")[1:])) for x in pii.find([new], field)[0][5].split(",") if x.startswith("field_")]
            tries, hits = tries + 1, hits + any(a < at + len(other) and at < b for a, b in found)
            false += sum(a >= at + len(other) for a, b in found) if not pii.base_spans(fake) else 0
    assert tries > 5 and hits >= 0.9 * tries and false <= 0.1 * hits
    # alone and among others, in batches of any size
    many = [t for _, t in texts(docs) if pii.base_spans(t)][:20] + [said, "", "12 34"]
    whole = pii.find(many, field)
    assert whole == [pii.find([t], field)[0] for t in many]
    monkeypatch.setattr(pii, "CHARS_AT_ONCE", 500)
    assert [r for _, some in pii.in_parts(many) for r in pii.find(some, field)] == whole
    monkeypatch.setattr(pii, "MOST_ROUNDS", 1)
    assert not pii.find([said], field)[0][7] and pii.find(["no numbers"], field)[0][7]


# --- 5: secrets ------------------------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


@pytest.fixture(scope="module")
def leaky(spark, odd):
    rnd = random.Random(3)
    parts = ["token", "secret: ", "passwd=", "API_KEY = '", "apikey", ":", "=", " ", '"', "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef01234567", "é", "\n", "x"]
    data = [(1000 + i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(2, 14)))) for i in range(400)]
    extra = spark.createDataFrame(data, "doc_id long, text string")
    return odd.select("doc_id", "text").unionByName(extra).unionByName(extra.limit(20))


def test_secret_report(leaky, docs):
    for df in (leaky, docs):
        expected = {d: brute_secrets(t) for d, t in texts(df)}
        out = secrets.report(df).collect()
        assert len(out) == df.count()
        for r in out:
            own = expected[r["doc_id"]]
            assert r["base_sha256"] == hashlib.sha256(own.encode()).hexdigest(), (own, r)
            assert {x for x in own.split(",") if x} <= {*r["spans"].split(",")}
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [own.count(k) for k in ("assign:", "access:", "hex:")]
    assert secrets.report(none(docs)).count() == 0


def test_ledger_scans_only_unseen_pairs(leaky):
    found, new = secrets.scan(leaky)
    half = new.filter(F.substring("blob", 1, 1) < "8")
    rest, more = secrets.scan(leaky, half)
    assert more.count() == new.count() - half.count()
    cols = ["blob", "kind", "order", "start", "end"]
    old = found.join(half.select("blob").distinct(), "blob").select(*cols)
    assert sorted(map(tuple, rest.select(*cols).unionByName(old).collect())) == sorted(map(tuple, found.select(*cols).collect()))
    again, none_new = secrets.scan(leaky, new)
    assert again.count() == none_new.count() == 0


def test_reports_and_masks_with_a_ledger_are_whole(leaky):
    first = leaky.filter("doc_id % 3 > 0").dropDuplicates(["doc_id"])
    ledger = secrets.ledger_rows(*secrets.scan(first))
    later = leaky.unionByName(leaky.filter("doc_id > 1000").select((F.col("doc_id") + 5000).alias("doc_id"), "text"))
    assert by_id(secrets.report(later, ledger=ledger)) == by_id(secrets.report(later))
    assert by_id(secrets.redact(later, ledger=ledger)) == by_id(secrets.redact(later))
    # a ledger of pairs alone says nothing of what was found
    assert by_id(secrets.report(first, ledger=ledger.select("blob", "rule_version"))) == by_id(secrets.report(first))


def test_second_run_scans_the_rest_and_appends(spark, leaky, tmp_path, monkeypatch):
    """With a ledger's path: a second run looks at blobs that are new only, leaves the files of the first one and gives what one full run gives."""
    from pathlib import Path

    at = f"file://{tmp_path}/ledger"
    first = leaky.filter("doc_id % 2 = 0")
    kept = secrets.remember(first, at)
    blobs = {r["blob"] for r in secrets.blobs_of(first).collect()}
    assert kept.count() == len(blobs) * len(secrets.RULES)
    files = {str(f): f.read_bytes() for f in Path(f"{tmp_path}/ledger").rglob("*.parquet")}
    scanned = []
    own = secrets.find
    monkeypatch.setattr(secrets, "find", lambda b, rules: scanned.append({r["blob"] for r in b.select("blob").collect()}) or own(b, rules))
    both = by_id(secrets.report(leaky, ledger=at))
    monkeypatch.undo()
    assert len(scanned) == 1 and not scanned[0] & blobs
    assert both == by_id(secrets.report(leaky))
    assert files.items() <= {str(f): f.read_bytes() for f in Path(f"{tmp_path}/ledger").rglob("*.parquet")}.items()
    whole = secrets.read_ledger(spark, at)
    every = {r["blob"] for r in secrets.blobs_of(leaky).collect()}
    assert whole.count() == len(every) * len(secrets.RULES)
    assert by_id(secrets.redact(leaky, ledger=at)) == by_id(secrets.redact(leaky)) and secrets.read_ledger(spark, at).count() == whole.count()
    # a further rule is run on all blobs, the others on none
    more = secrets.Rule("tie", r"tie one", "tie")
    assert secrets.remember(leaky, at, (*secrets.RULES, more)).count() == len(every) * (len(secrets.RULES) + 1)
    assert secrets.remember(leaky.filter("false"), f"file://{tmp_path}/none").count() == 0


def test_whole_keys_are_masked(spark):
    begin, end, line = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "MIIEow" + "Ab+/" * 14 + "=="
    keys = [f"{begin}\nProc-Type: 4,ENCRYPTED\n\n{line}\n{line}\n{end}", f"{begin}\n{line}\n{line}"]
    data = [(1, f"before {keys[0]} after"), (2, f"before {keys[1]}\n\nand then some words"), (3, f"{begin} is how it starts"), (4, "-----BEGIN CERTIFICATE-----")]
    out = {r["doc_id"]: r["text"] for r in secrets.redact(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert out == {1: "before [SECRET] after", 2: "before [SECRET]\n\nand then some words", 3: "[SECRET] is how it starts", 4: data[3][1]}


def test_redaction_leaves_no_finding(leaky, docs):
    for df in (leaky, docs):
        clean = secrets.redact(df, secrets.BASE)
        assert clean.columns == df.columns and clean.count() == df.count()
        assert not any(brute_secrets(t.replace("[SECRET]", "!")) for _, t in texts(clean))
        before, after = dict(texts(df)), dict(texts(clean))
        assert all(after[d] == t for d, t in before.items() if not brute_secrets(t))


# --- 6: near duplicates ----------------------------------------------------------------------------------------------


def brute_components(data):
    def shingles(t):
        w = t.encode().lower().split()
        return frozenset(b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {d: shingles(t) for d, t in data if d is not None}
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            k = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


def test_near_duplicates(spark, docs, odd):
    rnd = random.Random(8)
    made = []
    for base in range(12):
        words = [f"w{rnd.randrange(60)}" for _ in range(rnd.choice([6, 12, 40, 150]))]
        for _ in range(12):
            own = list(words)
            for _ in range(rnd.randrange(0, max(2, len(words) // 12))):
                own[rnd.randrange(len(own))] = f"v{rnd.randrange(9)}"
            made.append((len(made) + 5000, " ".join(own + ["common tail of many words here"] * (base % 2))))
    for df in (spark.createDataFrame(made, "doc_id long, text string"), docs, odd):
        expected = brute_components(texts(df))
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity_join.joined(df).collect() if r["doc_id"] is not None}
        assert got == expected
        kept = {r["doc_id"] for r in parity_join.keep_one(df).collect()}
        assert kept - {None} == {c for _, c in expected.values()}
    assert parity_join.joined(none(docs)).count() == 0


def test_links_are_all_links(spark, monkeypatch):
    """n_links in a large family, in chains and in pairs, whether a component is one part or many."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    made = []
    for _ in range(150):  # most but not all of them are similar to each other
        own = list(base)
        for _ in range(rnd.choice([1, 2])):
            own[rnd.randrange(len(own))] = f"v{rnd.randrange(10**6)}"
        made.append(own)
    for start in range(0, 60, 3):  # a chain: ends aren't similar
        made.append([f"c{i}" for i in range(start, start + 80)])
    made += [[f"p{k}q{i}" for i in range(30)] for k in range(5)] + [[f"p{k}q{i}" for i in range(29)] for k in range(5)]
    data = [(i, " ".join(w)) for i, w in enumerate([*made, *made[:20]])]
    sets = {d: frozenset(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for d, t in data}
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    expected = {d: sum(near(s, x) for x in {*sets.values()} - {s}) for d, s in sets.items()}
    assert max(expected.values()) > 100
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    for tile in (1000, 40):
        monkeypatch.setattr(parity_join, "TILE", tile)
        assert {r["doc_id"]: r["n_links"] for r in parity_join.joined(df).collect()} == expected


def test_sets_of_long_texts_and_of_any_words(monkeypatch):
    """Texts hashed in stretches have the sets of whole ones, and equal words give equal sets whatever stands between them."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(11)
    texts_ = [None, "", " \t", "a b", "A  B\n", "é" * 200, "x" * 900, " ".join(rnd.choice(["ab", "CD", "e\x0bf", "日本 \r g"]) for _ in range(700)), "", "a b c d e f"]
    made = lambda: {i + low: tuple(h[sum(n[:i]) : sum(n[: i + 1])].tolist()) for low, _, h, n in parity_join.sets_in(pa.array(texts_)) for i in range(len(n))}
    whole = made()
    assert [len(whole[i]) for i in (0, 1, 2, 3, 5, 6, 9)] == [0, 0, 0, 1, 1, 1, 2] and whole[3] == whole[4]
    words = texts_[7].lower().split()
    assert len(whole[7]) == len({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    for at_once in (1, 7, 64):
        monkeypatch.setattr(parity_join, "AT_ONCE", at_once)
        assert made() == whole
    assert np.array_equal(parity_join.forest(np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4]), 6), [True, False, True, True])


@pytest.mark.parametrize("table", [0, 4096])
def test_pairs_of_a_tile(monkeypatch, table):
    """A forest of the close pairs first, then the closest pairs of components; groups that lose a pair are named."""
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(parity_join, "TABLE", table)
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 1 << 63, 100).astype(np.uint64)
    sets = [np.r_[base[:95], rnd.integers(0, 1 << 63, 5).astype(np.uint64)] for _ in range(20)] + [rnd.integers(0, 1 << 63, 100).astype(np.uint64) for _ in range(5)]
    rows = pd.DataFrame({"cls": range(25), "n": 100, "bits": [parity_join.parity_bits(x) for x in sets], "component": range(25), "part": [k % 2 for k in range(25)]})
    for i, j in ((0, 0), (0, 1)):
        own = rows[rows["part"].isin([i, j])].assign(i=i, j=j)
        groups = pd.concat([own.assign(sig=s) for s in (5, 6)] + [own[own["cls"] >= 20].assign(sig=7)])
        out = parity_join.close_in_tile(groups, None)
        pairs = out[out["sig"].isna()]
        assert len(pairs) == int(own["cls"].lt(20).sum()) - 1 and pairs[["a", "b"]].max().max() < 20
        assert {*out["sig"].dropna()} == {5, 6}
        again = parity_join.close_in_tile(groups.assign(component=groups["cls"] % 4 // 2), 3)
        assert int(again["sig"].isna().sum()) == 3
        assert len(parity_join.close_in_tile(groups.assign(component=1), 3)) == 0


# --- 7: quality ------------------------------------------------------------------------------------------------------


def brute_quality(t):
    blank = " \t\n\x0b\f\r"
    words = [w for w in re.split(f"[{blank}]+", t) if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if x.strip(blank)]
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len({*lines}), len(hit), failed


def test_quality_counts_and_verdicts(spark, docs, odd):
    for df in (odd, docs):
        expected = {d: brute_quality(t) for d, t in texts(df)}
        out = quality.report(df).collect()
        assert len(out) == df.count()
        for r in out:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == expected[r["doc_id"]]
            assert not (r["base_failed"] and r["kept"])
        assert quality.keep_good(df).columns == df.columns
    assert quality.report(none(docs)).count() == 0


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    kept = quality.report(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "kept", "base_failed")
    r = kept.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed")
    n = r.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double")).alias("right"), F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("double"))).alias("clean")).first()
    assert n["right"] > 0.95 and n["clean"] > 0.97


def test_estimation_weighs_rules():
    good = quality.posterior([((1, 1, 1), 900), ((-1, 1, 1), 30), ((1, -1, 1), 30), ((1, 1, 0), 40)])
    assert good[(1, 1, 1)] > 0.8 > 0.5 > good[(-1, 1, 1)]
    assert quality.posterior([]) == {}


# --- 1: benchmark ----------------------------------------------------------------------------------------------------


def test_benchmark_cases(spark):
    item = "In the year Paris sold 30 kg of sweet apples and 12 kg of pears to old Marie for 55 dollars each day"
    bench = [(1, item), (2, "too short now"), (3, None), (4, ""), (5, "12 34")]
    other = item.replace("30", "77").replace("12", "19").replace("Paris", "London").replace("55", "66")
    mixed = item.replace("of pears to old", "of pears to 30 old").replace("30 kg", "77 kg")
    cases = [
        (1, f"Some words before. {item} And some after."),
        (2, other),
        (3, "Nothing of that kind is in this text at all, with 30 kg of stones and Paris"),
        (4, item.replace("30 kg", "7 kg").replace("12 kg", "7 kg")),
        (5, "well too short now indeed"),
        (6, None),
        (7, ""),
        (8, " ".join(item.split()[:9])),
    ]
    df = spark.createDataFrame(cases, "doc_id long, text string").withColumn("item_id", F.lit(9)).withColumn("hash", F.lit("x"))
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["kind"]) for r in decontaminate.found_items(df, b).collect()}
    assert got == {(1, 1, "verbatim"), (2, 1, "changed"), (5, 2, "verbatim")}
    assert mixed != item
    left = decontaminate.drop_found(df, b)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {3, 4, 6, 7, 8}
    assert decontaminate.found_items(none(df), b).count() == 0 == decontaminate.found_items(df, none(b)).count()


def test_units_after_blanks_and_wrapped_copies_are_found(spark):
    b = spark.createDataFrame([(1, "the runner went 5 km along the river and then 20 % more than the coach had asked"), (2, "we met our friends Anna and Boris with Clara near the old bridge of Prague")], "item_id long, text string")
    cases = [
        (1, "the runner went 5 miles along the river and then 20 percent more than the coach had asked"),
        (2, "we met our friends\nAnna and\tBoris with  Clara near the old bridge of\r\n Prague"),
        (3, "the runner went  5\nkm along the river and then 20% more than the coach had asked"),
    ]
    got = {(r["doc_id"], r["item_id"], r["kind"]) for r in decontaminate.found_items(spark.createDataFrame(cases, "doc_id long, text string"), b).collect()}
    assert got == {(1, 1, "changed"), (2, 2, "verbatim"), (3, 1, "verbatim")}


def test_numbers_as_words_repeated_rows_and_long_texts(spark):
    b = spark.createDataFrame([(1, "a farmer keeps twelve white sheep and forty brown goats behind the old mill")], "item_id long, text string")
    text = "a farmer keeps 7 white sheep and ninety brown goats behind the old mill"
    cases = [(1, text), (1, text), (2, "stone " * 60_000 + text + " river" * 60_000), (3, text.replace("ninety", "7"))]
    got = [(r["doc_id"], r["item_id"], r["kind"]) for r in decontaminate.found_items(spark.createDataFrame(cases, "doc_id long, text string"), b).collect()]
    assert sorted(got) == [(1, 1, "changed"), (2, 1, "changed")]


def test_numbers_as_words_and_copies_in_one_case(spark):
    item = "when the farmer sold 25 brown cows and 13 old horses to his friend Boris in the town of Prague he was glad"
    plain = "each of the small boats left the harbour again before the evening storm came over the hills"
    b = spark.createDataFrame([(1, item), (2, plain), (2, plain)], "item_id long, text string")
    cases = [
        (1, "well: " + item.replace("25", "twenty-five").replace("13", "Thirty-One") + " indeed"),
        (2, "SOME WORDS FIRST " + item.upper() + " AND MORE"),
        (3, "and so " + item.lower() + ", they say"),
        (4, "In a text of both cases: " + item.upper() + ". That was it."),
        (5, plain.upper()),
        (6, item.replace("Boris", "Clara").replace("Prague", "Vienna")),
        (7, item.upper().replace("BORIS", "CLARA").replace("25", "7")),
        (8, plain.replace("small", "twenty-two").replace("boats", "cars").replace("harbour", "garage").replace("storm", "rain")),
    ]
    df = spark.createDataFrame(cases, "doc_id long, text string").withColumn("named", F.lit(False))
    got = {(r["doc_id"], r["item_id"], r["kind"]) for r in decontaminate.found_items(df, b).collect()}
    assert {(1, 1, "changed"), (2, 1, "verbatim"), (3, 1, "verbatim"), (4, 1, "verbatim"), (5, 2, "verbatim"), (6, 1, "changed")} == {x for x in got if x[0] != 7}
    assert len(decontaminate.found_items(df, b).collect()) == len(got)


def test_benchmark_passages_are_found(spark, docs):
    b = spark.read.parquet(f"{SF}/benchmark.parquet")
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [(r["item_id"], norm(r["text"])) for r in b.collect()]
    brute = {(d, i) for d, t in texts(docs) for i, x in items if x in norm(t)}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.found_items(docs, b).collect()}
    assert brute <= got and len(got) <= len(brute) + 1


# --- 8: urls ---------------------------------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = ["https://X.example.ORG/es/1?q", "http://example.org/en/12", "http://example.org/en/2", "http://a.com/fr/x", "a.com/de/", "http://a.com/de/", "http://org?x", None, "", "http://notexample.org/es/", "ftp://h.net#f/x", "http://org/", "x://y://z/p"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("html", F.lit(None).cast("string")).withColumn("rule", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filtered(df).collect()}
    assert got[0] == ("x.example.org", "/es/1", "example.org/es/", "block")
    assert got[1][2:] == ("example.org/en/1", "block") and got[2][2:] == ("org/", "allow") and got[3][2:] == ("com/fr/", "allow")
    assert got[4][:3] == ("", "", None) and got[5][2:] == ("com/de/", "block") and got[6][:3] == ("org", "", None)
    assert got[7][:3] == ("", "", None) == got[8][:3] and got[9][2:] == ("org/", "allow") and got[10][:3] == ("h.net", "", None)
    assert got[11][2:] == ("org/", "allow") and got[12][:2] == ("y:", "//z/p")
    assert url_filter.filtered(none(df)).count() == 0


def test_trust_flows_along_links_and_distrust_against_them(spark):
    link = lambda h: f'<p><a class="x" href="http://{h}/p">t</a><a href="/own">o</a>'
    pages = [("http://good.com/fr/1", link("friend.net")), ("http://friend.net/", link("far.net")), ("http://far.net/", ""), ("http://bad.com/de/1", ""), ("http://shady.net/", link("bad.com")), ("http://behind.net/", link("shady.net")), ("http://alone.net/", None)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["host"]: (r["verdict"], r["trust"], r["distrust"]) for r in url_filter.filtered(df).collect()}
    assert [got[h][0] for h in ("good.com", "friend.net", "far.net", "alone.net")] == ["allow"] * 4
    assert [got[h][0] for h in ("bad.com", "shady.net", "behind.net")] == ["block"] * 3
    assert abs(got["friend.net"][1] - 0.15 * 0.85) < 1e-9 and abs(got["behind.net"][2] - 0.15 * 0.85**2) < 1e-9


# --- 10: archives ----------------------------------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    long, trap = "é" * 600, "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" * 30
    data = [(1, "http://a/x?q#f", long), (2, "http://b", long), (2, "http://b", long), (3, None, None), (4, "http://c/\r\ny", ""), (5, "http://d", "short"), (6, "http://d", "short"), (7, "http://e", trap), (8, "http://e", trap), (None, "http://f", "n" * 1000)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    out = warc.round_trip(df)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    got = sorted(map(tuple, out.collect()), key=str)
    expected = [(1, 1200, sha(long), "revisit", 2), (2, 1200, sha(long), "response", None), (2, 1200, sha(long), "revisit", 2), (3, 0, sha(""), "response", None), (4, 0, sha(""), "response", None), (5, 5, sha("short"), "response", None), (6, 5, sha("short"), "response", None), (7, len(trap), sha(trap), "revisit", 8), (8, len(trap), sha(trap), "response", None), (None, 1000, sha("n" * 1000), "response", None)]
    assert got == sorted(expected, key=str)
    warc.write_archives(df, str(tmp_path / "w"), compression="none")
    whole = warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    assert len(whole) == len(data) and all(r["request"] and r["metadata"] for r in whole)
    assert {bytes(r["response"]["payload"]).decode() for r in whole if r["response"]["type"] == "response"} == {long, "", "short", trap, "n" * 1000}
    assert warc.round_trip(none(df)).count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Many small pages and some large ones: no file holds more than the bound, or one record; joins also where nothing is broadcast."""
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rnd = random.Random(2)
    data = [(i, f"http://a/{i}", rnd.choice("abc") * rnd.choice([10, 2000, 15_000, 120_000, 900_000])) for i in range(150)] + [(999, "http://big", "z" * (3 << 20))]
    df = spark.createDataFrame(data, "page_id long, url string, html string").coalesce(2)
    at = tmp_path / "w"
    warc.write_archives(df, str(at), compression="none")
    sizes = [f.stat().st_size for f in at.glob("*.txt")]
    assert len(sizes) < 150 and sorted(sizes)[-2] <= (1 << 20) + 10_000 and max(sizes) < (3 << 20) + 10_000
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"]) for r in warc.round_trip(df).collect()}
    last = {h: i for i, _, h in data}
    assert got == {i: (len(h), hashlib.sha1(h.encode()).hexdigest(), "revisit" if len(h) >= 1000 and last[h] != i else "response") for i, _, h in data}


def test_archive_sql(spark):
    got = queries.QUERIES["op10_warc"](spark, SF).toPandas()
    assert rows(got) == rows(connect(SF).sql(queries.ORACLES["op10_warc"]).df())
