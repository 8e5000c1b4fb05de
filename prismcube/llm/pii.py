"""Personal data by patterns and a skip-chain conditional random field (operator 2).

Patterns find the base spans. The field then labels every token that holds a digit
or an at sign: node potentials come from the token's shape, chain potentials tie
neighbours, and skip potentials tie all tokens of equal or similar form to one form
node of the text, which is observed where the patterns find the form, so that a value
which is recognised once is recognised wherever it stands again without its telling
form, however often and far away. Loopy inference passes messages along both kinds
of edges until they settle, in each text by itself. The weights are fitted by
pseudo-likelihood to the base labels of all documents, summed up by pattern of
features and neighbours. Since a repeat without its telling form has no base label,
how much repeats agree is learned from planted ones: each value that the patterns find
counts as if it stood there again in a form that they don't find, and as two look-alikes
of that form that are no repeats of a found value, one alone and one said twice.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The contract's kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
#: Labels: 0 is none, then the kinds. Largest change of settled messages, rounds that messages which never settle end after, belief from which a token counts.
LABELS, SETTLED, MOST_ROUNDS, BELIEF = 1 + len(KINDS), 1e-3, 1000, 0.9
FEATURES = 12
#: Characters of texts whose graph is held at once, unless one text is longer.
CHARS_AT_ONCE = 2_000_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, sorted; code points."""
    out = [(s, 0, e) for s, e in emails(text)]
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def shape(token: str) -> int:
    """The features of a token as bits; only its form, never whether a base pattern accepts it."""
    digits = sum("0" <= c <= "9" for c in token)
    return (
        ("@" in token)
        | ("." in token.partition("@")[2]) << 1
        | (token.count(".") == 3) << 2
        | (token[:1] in "+(" or token[1:2] == "+") << 3
        | ("-" in token) << 4
        | (")" in token) << 5
        | (digits >= 2) << 6
        | (digits >= 4) << 7
        | (digits >= 7) << 8
        | (digits >= 12) << 9
        | (2 * digits >= len(token)) << 10
        | any(c.isalpha() for c in token) << 11
    )


def form(token: str) -> str | None:
    """What similar tokens have in common: the last seven digits of a number, or the lower-case letters and digits of a token with an at sign."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    if "@" in token:
        return "@" + "".join(c for c in token.lower() if c.isalnum() or c == "@")
    return digits[-7:] if len(digits) >= 7 else None


class Graph:
    """The tokens of many texts as one graph: parts of different texts aren't linked."""

    def __init__(self) -> None:
        self.text: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.bits: list[int] = []
        self.label: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []  # neighbours of one form, to fit by
        self.form: list[tuple[int, int]] = []  # token and form node, to infer by
        self.forms = 0

    def add(self, number: int, text: str, base: list[tuple[int, int, int]]) -> None:
        seen: dict[str, int] = {}
        same: dict[str, list[int]] = {}
        k, before = 0, None
        for m in TOKEN.finditer(text):
            start, end = m.span()
            i = len(self.span)
            while k < len(base) and base[k][2] <= start:
                k += 1
            label = 1 + base[k][1] if k < len(base) and base[k][0] < end else 0
            if before is not None and start - before <= 2:
                self.chain.append((i - 1, i))
            key = form(m.group())
            if key is not None:
                if key in seen and seen[key] != i - 1:
                    self.skip.append((seen[key], i))
                seen[key] = i
                same.setdefault(key, []).append(i)
            self.text.append(number)
            self.span.append((start, end))
            self.bits.append(shape(m.group()))
            self.label.append(label)
            before = end
        for tokens in same.values():
            if len(tokens) > 1:
                self.form += [(i, self.forms) for i in tokens]
                self.forms += 1

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        edge = lambda x: np.array(x, np.int64).reshape(-1, 2)
        return np.array(self.bits, np.int64), np.array(self.label, np.int64), edge(self.chain), edge(self.skip)


def design(bits: np.ndarray) -> np.ndarray:
    return np.c_[np.ones(len(bits)), (bits[:, None] >> np.arange(FEATURES)) & 1]


class Field:
    """Weights of nodes (labels x features), chain pairs (labels x labels) and skip pairs (one for agreement)."""

    def __init__(self, node: np.ndarray, chain: np.ndarray, skip: float):
        self.node, self.chain, self.skip = node, chain, skip

    @classmethod
    def fit(cls, counts: pd.DataFrame, steps: int = 300, ridge: float = 1.0) -> Field:
        """counts: bits, label, left, right, skip (labels of neighbours, -1: none), n. Gradient ascent on the pseudo-likelihood."""
        k = LABELS
        node, chain, agree = np.zeros((k, FEATURES + 1)), np.zeros((k, k)), 0.0
        n = counts["n"].to_numpy(float)
        if not len(n) or n.sum() == 0:
            return cls(node, chain, agree)
        x = design(counts["bits"].to_numpy(np.int64))
        hot = lambda c: np.eye(k + 1)[counts[c].to_numpy(np.int64)][:, :k]  # noqa: E731  -1 is the last row, cut off
        y, left, right, skip = hot("label"), hot("left"), hot("right"), hot("skip")
        n = n / n.sum()
        rate = 2.0
        for _ in range(steps):
            score = x @ node.T + left @ chain + right @ chain.T + agree * skip
            p = np.exp(score - score.max(1, keepdims=True))
            off = (y - p / p.sum(1, keepdims=True)) * n[:, None]
            node += rate * (off.T @ x - 1e-4 * ridge * node)
            chain += rate * (left.T @ off + off.T @ right - 1e-4 * ridge * chain)
            agree += rate * ((off * skip).sum() - 1e-4 * ridge * agree)
        return cls(node, chain, max(0.0, float(agree)))

    def beliefs(self, bits: np.ndarray, known: np.ndarray, chain: np.ndarray, form: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of every token once the messages have settled, and whether those of each text did within MOST_ROUNDS; tokens
        with a base label, and forms that most often have it, are held to it."""
        tokens, k = len(bits), LABELS
        forms = form[:, 1].max() + 1 if len(form) else 0
        votes = np.zeros((forms, k), np.int64)
        np.add.at(votes, (form[:, 1], known[form[:, 0]]), 1)
        votes[:, 0] = 0
        known = np.r_[known, votes.argmax(1)] if forms else known
        n, skip = tokens + forms, np.c_[form[:, 0], form[:, 1] + tokens]
        own = np.r_[design(bits) @ self.node.T, np.zeros((forms, k))]
        own[known > 0] = -50.0
        own[known > 0, known[known > 0]] = 0.0
        ends = np.r_[chain, chain[:, ::-1], skip, skip[:, ::-1]]
        tie = self.skip * np.eye(k)
        pair = np.r_[np.repeat(self.chain[None], len(chain), 0), np.repeat(self.chain.T[None], len(chain), 0), np.repeat(tie[None], 2 * len(skip), 0)]
        c, s = len(chain), len(skip)
        back = np.r_[np.arange(c) + c, np.arange(c), 2 * c + s + np.arange(s), 2 * c + np.arange(s)].astype(np.int64)
        message = np.zeros((len(ends), k))
        # a text's messages rest once they have settled, so what they settle to doesn't depend on the other texts
        place = np.r_[text, text[form[np.unique(form[:, 1], return_index=True)[1], 0]]] if forms else text
        open_ = np.arange(len(ends))
        settled = np.ones(int(text.max()) + 1 if tokens else 0, bool)

        def gathered() -> np.ndarray:
            return own + np.stack([np.bincount(ends[:, 1], message[:, j], n) for j in range(k)], 1) if len(ends) else own

        for _ in range(MOST_ROUNDS):
            if not len(open_):
                break
            from_ = gathered()[ends[open_, 0]] - message[back[open_]]
            made = from_[:, :, None] + pair[open_]
            top = made.max(1)
            made = top + np.log(np.exp(made - top[:, None, :]).sum(1))
            made -= made.max(1, keepdims=True)
            change = np.zeros(len(settled))
            np.maximum.at(change, place[ends[open_, 0]], np.abs(made - message[open_]).max(1))
            message[open_] = 0.5 * message[open_] + 0.5 * made
            open_ = open_[change[place[ends[open_, 0]]] >= SETTLED]
        settled[place[ends[open_, 0]]] = False
        score = gathered()[:tokens]
        p = np.exp(score - score.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True), settled


def disguised(kind: int, value: str) -> str:
    """A value in a form that its pattern doesn't find: an address without the dots behind its sign, an ip with hyphens, a card in
    groups with strokes, a phone's digits."""
    digits = "".join(c for c in value if "0" <= c <= "9")
    if kind == 0:
        name, _, place = value.partition("@")
        return f"{name}@{place.replace('.', '')}"
    return value.replace(".", "-") if kind == 1 else "/".join(digits[i : i + 4] for i in range(0, len(digits), 4)) if kind == 2 else digits


def planted(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(bits, label, left, right, skip) of a repeat of each base value in another form, and of two look-alikes of it."""
    for start, kind, end in base:
        other = disguised(kind, text[start:end])
        if form(other) is not None and not base_spans(other):
            for label, skip in ((1 + kind, 1 + kind), (0, -1), (0, 0)):
                yield shape(other), label, -1, -1, skip


COUNTS = "bits long, label long, left long, right long, skip long, n long"


def neighbour_counts(docs: DataFrame) -> DataFrame:
    """How often each pattern of features, base label and neighbours' base labels occurs in all documents, planted ones included."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found: Counter = Counter()
            for _, texts in in_parts([x or "" for x in rows["text"]]):
                g = Graph()
                for i, text in enumerate(texts):
                    if "@" in text or DIGIT.search(text):
                        base = base_spans(text)
                        g.add(i, text, base)
                        found.update(planted(text, base))
                bits, label, chain, skip = g.arrays()
                out = np.full((len(bits), 5), -1, np.int64)
                out[:, 0], out[:, 1] = bits, label
                out[chain[:, 1], 2] = label[chain[:, 0]]
                out[chain[:, 0], 3] = label[chain[:, 1]]
                out[skip[:, 0], 4] = label[skip[:, 1]]
                out[skip[:, 1], 4] = label[skip[:, 0]]
                found.update(map(tuple, out.tolist()))
            yield pd.DataFrame([(*x, n) for x, n in found.items()], columns=["bits", "label", "left", "right", "skip", "n"], dtype=np.int64)

    each_batch = docs.select("text").mapInPandas(each, COUNTS)
    return each_batch.groupBy("bits", "label", "left", "right", "skip").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Field:
    """The field for docs. What comes to the driver is one row for each pattern of 12 bits and four labels, not for tokens."""
    return Field.fit(neighbour_counts(docs).toPandas().sort_values(["bits", "label", "left", "right", "skip"]))


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k] if k < len(KINDS) else 'field_' + KINDS[k - len(KINDS)]}:{s}:{e}" for s, k, e in spans)


def added_spans(g: Graph, beliefs: np.ndarray, base: dict[int, list[tuple[int, int, int]]], texts: list[str]) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of neighbouring tokens of one label outside the base spans, by text, without punctuation around them."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    label = np.where(beliefs.max(1) >= BELIEF, beliefs.argmax(1), 0)
    linked = {b for _, b in g.chain}
    run: list[int] | None = None
    for i in np.flatnonzero((label > 0) & (np.array(g.label) == 0)).tolist():
        text, (start, end), kind = g.text[i], g.span[i], int(label[i])
        if run and run[4] == i - 1 and i in linked and run[0] == text and run[3] == kind:
            run[2], run[4] = end, i
            out[text][-1] = (run[1], len(KINDS) + kind - 1, end)
        else:
            run = [text, start, end, kind, i]
            out.setdefault(text, []).append((start, len(KINDS) + kind - 1, end))
    clean: dict[int, list[tuple[int, int, int]]] = {}
    for number, spans in out.items():
        own = base.get(number, [])
        for s, k, e in spans:
            while s < e and not (texts[number][s].isalnum() or texts[number][s] in "+("):
                s += 1
            while s < e and not texts[number][e - 1].isalnum():
                e -= 1
            if s < e and not any(a < e and s < b for a, _, b in own):
                clean.setdefault(number, []).append((s, k, e))
    return clean


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, settled boolean"


def in_parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Texts, some at a time, and the place of the first of them."""
    low, held = 0, 0
    for i, x in enumerate(texts):
        if i > low and held + len(x) > CHARS_AT_ONCE:
            yield low, texts[low:i]
            low, held = i, 0
        held += len(x)
    if texts:
        yield low, texts[low:]


def find(texts: list[str], field: Field) -> list[tuple]:
    """What report() tells of each text, but doc_id."""
    g, base = Graph(), {}
    for i, text in enumerate(texts):
        if "@" in text or DIGIT.search(text):
            base[i] = base_spans(text)
            g.add(i, text, base[i])
    bits, label, chain, _ = g.arrays()
    more, settled = {}, np.ones(0, bool)
    if len(bits):
        beliefs, settled = field.beliefs(bits, label, chain, np.array(g.form, np.int64).reshape(-1, 2), np.array(g.text, np.int64))
        more = added_spans(g, beliefs, base, texts)
    out = []
    for i in range(len(texts)):
        own = base.get(i, [])
        kinds = Counter(k for _, k, _ in own)
        every = sorted(own + more.get(i, []))
        out.append((*(kinds[k] for k in range(len(KINDS))), hashlib.sha256(named(own).encode()).hexdigest(), named(every), len(every), bool(settled[i]) if i < len(settled) else True))
    return out


def report(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, settled of every row; the field is fitted to docs if none is given.

    Null texts count as empty; repeated rows repeat; an empty table gives no rows. Spans that the field adds have kinds
    field_email and so on and never overlap base spans. settled is false where a text's messages had not come to rest
    after MOST_ROUNDS, so that its added spans are a guess. A text's result doesn't depend on the rows beside it.
    """
    field = field or fit(docs)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for low, texts in in_parts([x or "" for x in rows["text"]]):
                made = pd.DataFrame(find(texts, field), columns=[x.split()[0] for x in RESULT.split(", ")[1:]])
                made.insert(0, "doc_id", rows["doc_id"].to_numpy()[low : low + len(texts)])
                yield made

    return docs.select("doc_id", "text").mapInPandas(each, RESULT)
