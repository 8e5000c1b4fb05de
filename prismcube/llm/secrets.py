"""Secret scans with a ledger of blobs (operator 5), in DataFrame functions only.

Every version of a text is a blob named by its SHA-256. A scan looks only at
(blob, rule version) pairs that the ledger doesn't hold yet, one copy of each
blob, and reads the texts once for all rules. The ledger is a table under a path,
in folders by rule version, that keeps what was found for each pair and is only
ever appended to; every report and redaction first brings it up to date and then
joins its findings back to all rows that have the blob. Who keeps the path hands
it to the next run.

Positions come from marks: a rule's matches are wrapped in two marker characters,
the text is split at the opening one, and running sums of the pieces' lengths
give the starts. The marker characters are replaced in the text first, one for
one, so that positions stay; no rule matches them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prismcube.llm.common import States, scratch, text_of, written

#: Two private-use characters as marks, and what stands for them should a text hold them.
OPEN, CLOSE, INSTEAD = "\ue000", "\ue001", "\ufffd"


@dataclass(frozen=True)
class Rule:
    """pattern finds candidates; ``valid``, if given, must match a candidate from its start to its end. hint: a necessary condition."""

    kind: str
    pattern: str
    hint: str
    valid: str | None = None

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.kind}\0{self.pattern}\0{self.valid}".encode()).hexdigest()[:16]


_NAMES = r"(?:(?i:password|passwd|secret|token|api_?key))"
_GIVEN = r"""["']?\x20*+[:=]\x20*+["']?"""
#: The contract's kinds, in its order, then the kinds that this scanner adds.
BASE = (
    Rule("assign", _NAMES + _GIVEN + r"[A-Za-z0-9+/_.=-]++", r"(?i:passw|secret|token|api_?key)", _NAMES + _GIVEN + r"[A-Za-z0-9+/_.=-]{6,}"),
    Rule("access", r"AKIA[A-Z0-9]{16,}+", r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", r"[0-9a-f]{24}"),
)
#: What stands in a key: base64, its blanks and header lines, single hyphens. A key without its END line goes on over lines of base64.
_BODY = r"[A-Za-z0-9+/=:,\s]*+(?:-(?!----)[A-Za-z0-9+/=:,\s]*+)*+"
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:" + _BODY + r"-----END [A-Z ]{0,30}PRIVATE KEY-----|(?:\s*+[A-Za-z0-9+/=]{32,}+)*+)", r"PRIVATE KEY-----"),
    Rule("bearer", r"(?<![A-Za-z])[Bb]earer\x20++[A-Za-z0-9+/_.~-]{20,}+=*+", r"[Bb]earer\x20"),
    Rule("forge", r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}+", r"gh[pousr]_[A-Za-z0-9]{36}"),
)
RULES = BASE + ADDED
#: Rows and characters of the findings of blobs up to which they are broadcast; beyond, rows are shuffled to them.
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 1 << 25
LEDGER = "blob string, rule_version string, spans array<struct<start: bigint, end: bigint>>"


def marked(text: Column, rule: Rule) -> Column:
    """The text with the rule's valid matches between marks."""
    clean = F.regexp_replace(text, f"[{OPEN}{CLOSE}]", INSTEAD)
    out = F.regexp_replace(clean, f"({rule.pattern})", f"{OPEN}$1{CLOSE}")
    if rule.valid:  # take the marks off the others
        out = F.regexp_replace(out, f"{OPEN}(?!{rule.valid}{CLOSE})([^{CLOSE}]*+){CLOSE}", "$1")
    return out


def hinted(rules: tuple[Rule, ...]) -> str:
    return "|".join(r.hint for r in rules)


def find(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """kind, order, start, end (code points) of all matches in blobs (key columns ``blob``, ``text``), or of those of the rules in ``versions``."""
    hit = blobs.filter(F.col("text").rlike(hinted(rules)))
    wanted = lambda r: F.col("text").rlike(r.hint) & (F.array_contains("versions", r.version) if "versions" in blobs.columns else F.lit(True))
    each = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(i).alias("order"), F.split(F.when(wanted(r), marked(F.col("text"), r)), OPEN).alias("parts")) for i, r in enumerate(rules)))
    parts = hit.select("blob", F.explode(each).alias("r")).filter(F.size("r.parts") > 1)
    parts = parts.select("blob", "r.kind", "r.order", F.posexplode("r.parts").alias("n", "part"))
    cut = F.instr("part", CLOSE)  # 0 in the first part only, which holds no match
    parts = parts.select("blob", "kind", "order", "n", (cut - 1).alias("size"), (F.length("part") - F.when(cut > 0, 1).otherwise(0)).alias("whole"))
    before = Window.partitionBy("blob", "order").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    found = parts.withColumn("start", F.sum("whole").over(before)).filter(F.col("n") > 0)
    return found.select("blob", "kind", "order", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("size")).cast("long").alias("end"))


def blobs_of(docs: DataFrame) -> DataFrame:
    """doc_id, blob: the content address of each whole text (null: empty)."""
    return docs.select("doc_id", F.sha2(text_of().cast("binary"), 256).alias("blob"))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings (blob, kind, order, start, end) of the pairs that the ledger lacks, and the ledger rows (blob, rule_version) to add.

    Each blob is read from one row, one of the least doc_id (a null one where all are null). Rules whose version the ledger has for a blob aren't run on it.
    """
    seen = blobs_of(docs).groupBy("blob").agg(F.min("doc_id").alias("path"))
    if ledger is None:
        new = seen.select("blob", F.explode(F.lit([r.version for r in rules])).alias("rule_version"))
        todo = seen
    else:
        pairs = seen.withColumn("rule_version", F.explode(F.lit([r.version for r in rules]))).join(ledger.select("blob", "rule_version").distinct(), ["blob", "rule_version"], "left_anti")
        new = pairs.select("blob", "rule_version")
        todo = pairs.groupBy("blob", "path").agg(F.collect_set("rule_version").alias("versions"))
    texts = docs.select("doc_id", text_of().alias("text"))
    same = texts["doc_id"].eqNullSafe(todo["path"]) & (F.sha2(texts["text"].cast("binary"), 256) == todo["blob"])
    one = texts.join(todo.hint("shuffle_hash"), same).filter(F.col("text").rlike(hinted(rules))).dropDuplicates(["blob"])
    return find(one, rules), new


def ledger_rows(found: DataFrame, new: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows (LEDGER) to add for what scan() returned: empty spans where a rule found nothing."""
    version = F.element_at(F.lit([r.version for r in rules]), F.col("order") + 1)
    spans = found.groupBy("blob", version.alias("rule_version")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return new.join(spans, ["blob", "rule_version"], "left").select("blob", "rule_version", F.coalesce("spans", none).alias("spans"))


def read_ledger(spark: SparkSession, at: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The pairs of rules (LEDGER) that are kept under a path; none where nothing was written yet. A pair counts once, however often
    it was written."""
    try:
        kept = spark.read.schema(LEDGER).parquet(at)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
    return kept.filter(F.col("rule_version").isin([r.version for r in rules]))


def remember(docs: DataFrame, at: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger under a path, after what it lacked of docs was scanned and appended to it.

    Runs that add to one ledger at the same time may both scan a new pair; it counts once.
    """
    kept = read_ledger(docs.sparkSession, at, rules)
    new = ledger_rows(*scan(docs, kept if kept.head(1) else None, rules), rules)
    written(new.select("blob", "spans", "rule_version"), at, "append", ("rule_version",))
    return read_ledger(docs.sparkSession, at, rules)


def kept_at(docs: DataFrame, ledger: DataFrame | str | None) -> str:
    """Where a run's ledger is: the path that is given, or a new one, which starts with a given table's pairs that have spans."""
    if isinstance(ledger, str):
        return ledger
    at = scratch(docs.sparkSession, "ledger")
    if ledger is not None and "spans" in ledger.columns:
        written(ledger.filter("spans is not null").select("blob", "spans", "rule_version"), at, "append", ("rule_version",))
    return at


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, kind, order, start, end of all findings of rules that a ledger has for texts of docs."""
    kinds = F.array(*(F.struct(F.lit(r.version).alias("rule_version"), F.lit(r.kind).alias("kind"), F.lit(i).alias("order")) for i, r in enumerate(rules)))
    some = ledger.filter(F.size("spans") > 0).dropDuplicates(["blob", "rule_version"]).withColumn("r", F.explode(F.filter(kinds, lambda r: r["rule_version"] == F.col("rule_version"))))
    return some.select("blob", "r.kind", "r.order", F.explode("spans").alias("s")).select("blob", "kind", "order", "s.start", "s.end")


def dealt(found: DataFrame, chars: Column) -> DataFrame:
    """found to be broadcast where it is small; else adaptive execution splits a text of very many rows."""
    seen = found.agg(F.count("*").alias("n"), F.coalesce(F.sum(chars), F.lit(0)).alias("chars")).first()
    return F.broadcast(found) if seen["n"] <= BROADCAST_ROWS and seen["chars"] <= BROADCAST_CHARS else found


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans of every row; null texts count as empty, repeated rows repeat.

    ledger is the path of one, which is brought up to date and can be handed to the next run, or a table of an earlier run's pairs.
    """
    states = States(docs.sparkSession, "secrets")
    found = findings(docs, remember(docs, kept_at(docs, ledger), rules), rules)
    n = len(BASE)
    spans = found.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "order", "kind", "end"))).alias("all"))
    spans = spans.withColumn("base", F.filter("all", lambda s: s["order"] < n))
    counts = {f"n_{r.kind}": F.size(F.filter("base", lambda s: s["kind"] == r.kind)).cast("long") for r in BASE}  # noqa: B023  called at once
    spans = states.save(spans.select("blob", *(c.alias(k) for k, c in counts.items()), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"), F.size("all").cast("long").alias("n_spans")), "spans")
    back = blobs_of(docs).join(dealt(spans, F.length("spans")), "blob", "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in (*(f"n_{r.kind}" for r in BASE), "n_spans")}
    return back.withColumns(zero | {"base_sha256": F.coalesce("base_sha256", F.sha2(F.lit(""), 256)), "spans": F.coalesce("spans", F.lit(""))}).select("doc_id", *(f"n_{r.kind}" for r in BASE), "base_sha256", "spans", "n_spans")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]", ledger: DataFrame | str | None = None) -> DataFrame:
    """docs with every match in ``text`` of a blob for which the ledger, brought up to date, has findings replaced by the mask, rule by rule.

    n_chars, if there is such a column, follows the text. All other rows and columns stay as they are. (In a text with
    findings the marker characters themselves become replacement characters.)
    """
    states = States(docs.sparkSession, "secrets")
    found = findings(docs, remember(docs, kept_at(docs, ledger), rules), rules)
    blobs = states.save(found.select(F.col("blob").alias("_hit")).distinct(), "blobs")
    text = out = F.col("text")
    for r in rules:
        out = F.regexp_replace(marked(out, r), f"{OPEN}[^{CLOSE}]*+{CLOSE}", mask)
    named = docs.withColumn("_blob", F.sha2(text_of().cast("binary"), 256))
    done = named.join(dealt(blobs, F.lit(64)), F.col("_blob") == F.col("_hit"), "left").withColumn("text", F.when(F.col("_hit").isNotNull(), out).otherwise(text))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("_hit").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)
