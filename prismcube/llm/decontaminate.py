"""Benchmark decontamination by templates (operator 1), in DataFrame functions only.

Numbers, units after numbers and names (capitalised words inside a sentence) become
typed placeholders, so a question that was asked again with other values keeps its
template. An item with names has a second template in which they are words, for texts
that are in one case; words in capitals are no names. Windows of five template words are hash-joined with the benchmark's. An
item counts as found where at least 0.8 of its distinct windows stand in a text and
the values in its slots are consistent: wherever the item has one value, the text
has one value too, and the other way round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import States, text_of

WORDS, SHARE = 5, 0.8
#: Distinct benchmark windows (8 bytes each) up to which they are broadcast; beyond, both sides are shuffled by the window.
BROADCAST_WINDOWS = 2_000_000
#: Ids of documents up to which they are broadcast; beyond, texts are shuffled to them.
BROADCAST_IDS = 1_000_000
#: Placeholders: private-use characters, one for each type of slot.
NUMBER, UNIT, NAME = "\ue010", "\ue011", "\ue012"
#: What joins the parts of a number while it is made.
JOIN = "\ue013"
#: Numbers as words.
NUMBER_WORDS = "two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion"
#: The two parts of a number with a hyphen, from twenty-one to ninety-nine.
ONES = "one|two|three|four|five|six|seven|eight|nine"
TENS = "twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety"
_NUMBER = r"\p{N}++(?:[.,:/]\p{N}++)*+"
#: Units of measure.
UNITS = "km|cm|mm|m|kg|g|mg|lb|lbs|oz|l|ml|s|ms|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|meters?|metres?|feet|foot|inch|inches|dollars?|euros?|cents?|percent|degrees?|kmh|mph|usd|eur|gb|mb|kb|hz|khz|mhz|watts?|volts?"
#: The units that are words, in both numbers.
UNIT_WORDS = tuple(sorted({x.replace("?", "") for x in UNITS.split("|")} | {x[:-2] for x in UNITS.split("|") if x.endswith("?")}))
#: Runs of blanks but a single space; each becomes one, so that at most two follow a placeholder.
_BLANKS = r"[\s\p{Z}&&[^ ]][\s\p{Z}]*+| [\s\p{Z}]++"
_UNIT = rf"(?<={NUMBER} {{0,2}})(?i:{UNITS}|%|°C|°F|€|\$)(?![\p{{L}}\p{{N}}])"
_NAME = rf"\p{{Lu}}(?=\p{{Ll}})(?<=[\p{{L}}\p{{N}},;{NUMBER}-{NAME}] {{1,2}}.)\p{{L}}*+"
_MARKS = f"[{NUMBER}-{JOIN}]"
_BETWEEN = rf"[^\p{{L}}\p{{N}}{NUMBER}-{NAME}]+"


@dataclass(frozen=True)
class Slots:
    """The text after each step, and the pattern whose matches the next step replaced."""

    template: Column
    values: dict[str, tuple[Column, str]]


def canonical(text: Column) -> Slots:
    """The template of a text; values: for each placeholder, the string and pattern that give its values in order."""
    held = without_marks(text)
    numbers = with_numbers(held)
    units = with_units(numbers)
    return Slots(with_names(units), {NUMBER: (held, _NUMBER), UNIT: (numbers, _UNIT), NAME: (units, _NAME)})


def without_marks(text: Column) -> Column:
    clean = F.regexp_replace(F.when(text.rlike(_MARKS), F.regexp_replace(text, _MARKS, " ")).otherwise(text), _BLANKS, " ")
    return F.when(F.contains(clean, F.lit("ty-")) | F.contains(clean, F.lit("TY-")), with_hyphens(clean)).otherwise(clean)


def with_hyphens(text: Column) -> Column:
    """Numbers like twenty-one in digits, so that they are one number, and the same one as in digits."""
    for n, word in enumerate(TENS.split("|"), 2):
        text = F.regexp_replace(text, rf"(?i)\b{word}-(?=(?:{ONES})(?![\p{{L}}\p{{N}}]))", f"{n}{JOIN}")
    for n, word in enumerate(ONES.split("|"), 1):
        text = F.regexp_replace(text, f"(?i){JOIN}{word}", str(n))
    return text


def with_numbers(held: Column) -> Column:
    return F.when(held.rlike(r"\p{N}"), F.regexp_replace(held, _NUMBER, f" {NUMBER} ")).otherwise(held)


def with_units(numbers: Column) -> Column:
    return F.when(numbers.contains(NUMBER), F.regexp_replace(numbers, _UNIT, f" {UNIT} ")).otherwise(numbers)


def with_names(units: Column) -> Column:
    return F.regexp_replace(units, _NAME, f" {NAME} ")


def raw_words(rows: DataFrame) -> DataFrame:
    """rows and ``_raw``: the words of the template of ``text``, numbers and units as words still in place; names too in rows that are not ``named``.

    Each step is a column of its own: it is used several times by the next one, and made once.
    """
    steps = {"_held": without_marks(F.col("text")), "_numbers": with_numbers(F.col("_held")), "_units": with_units(F.col("_numbers"))}
    for name, step in steps.items():
        rows = rows.withColumn(name, step)
    last = with_names(F.col("_units"))
    last = F.when(F.col("named"), last).otherwise(F.col("_units")) if "named" in rows.columns else last
    return rows.withColumn("_raw", F.array_remove(F.split(F.lower(last), _BETWEEN), "")).drop(*steps)


def typed(words: Column) -> Column:
    """Words in which numbers as words, and unit words after them, are placeholders too."""
    number = lambda w: w.isin(*NUMBER_WORDS.split("|"))
    unit = lambda w, i: w.isin(*UNIT_WORDS) & (i > 0) & number(F.get(words, i - 1))
    each = F.transform(words, lambda w, i: F.when(number(w), NUMBER).when(unit(w, i), UNIT).otherwise(w))
    return F.when(F.exists(words, number), each).otherwise(words)


def with_words(rows: DataFrame) -> DataFrame:
    """rows and ``words``: the template of ``text``. The raw words are a column of their own, so that they are made once."""
    return raw_words(rows).withColumn("words", typed(F.col("_raw"))).drop("_raw")


def windows_of(words: Column, size: int) -> Column:
    """The hashes of all windows of ``size`` words, by place; nothing for shorter texts."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def slots_of(rows: DataFrame, key: str) -> DataFrame:
    """key, place (of the word), value (lower case) of every slot of rows (key, text, words)."""
    rows = raw_words(rows)
    values = canonical(F.col("text")).values
    as_words = F.transform("_raw", lambda w, i: F.when(w != F.get("words", i), F.struct(i.alias("place"), w.alias("value"))))
    each = [F.filter(as_words, lambda x: x.isNotNull())]
    for mark, (held, pattern) in values.items():
        places = F.filter(F.transform("_raw", lambda w, i: F.when(w == mark, i)), lambda x: x.isNotNull())  # noqa: B023  called at once
        found = F.regexp_extract_all(held, F.lit(pattern), F.lit(0))
        found = F.when(F.col("named"), found).otherwise(F.array().cast("array<string>")) if mark == NAME and "named" in rows.columns else found
        each.append(F.arrays_zip(places.alias("place"), F.transform(found, lambda x: F.lower(x)).alias("value")))
    slots = rows.select(key, F.explode(F.concat(*each)).alias("slot"))
    return slots.select(key, F.col("slot.place").alias("place"), F.col("slot.value").alias("value"))


def benchmark_windows(benchmark: DataFrame, states: States, size: int = WORDS) -> DataFrame:
    """item, named, text, words, size, windows of each template of each item; a shorter one is one window of all its words. The items' words are written once.

    item is item_id and which of its templates it is: that with names as slots, or, of items with names, that with names as words.

    Windows without a literal word say nothing and are left out; items of which nothing is left can't be found.
    """
    both = benchmark.select("item_id", text_of().alias("text"), F.explode(F.lit([True, False])).alias("named"))
    both = with_words(both.withColumn("item", F.struct("item_id", (~F.col("named")).alias("plain"))))
    named = with_units(with_numbers(without_marks(F.col("text")))).rlike(_NAME)
    items = states.save(both.filter(F.col("named") | named), "items")
    items = items.filter(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(size)))
    words = F.col("words")
    places = F.sequence(F.lit(1), F.size(words) - F.col("size") + 1)
    literal = lambda i: F.exists(F.slice(words, i, F.col("size")), lambda w: ~w.isin(NUMBER, UNIT, NAME))
    window = lambda i: F.when(literal(i), F.struct(F.xxhash64(F.slice(words, i, F.col("size"))).alias("hash"), (i - 1).alias("at")))
    return items.withColumn("windows", F.filter(F.transform(places, window), lambda x: x.isNotNull())).filter(F.size("windows") > 0)


def found_items(docs: DataFrame, benchmark: DataFrame, size: int = WORDS, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, n_windows (found), n_item_windows, n_slots, n_changed, kind of every item found in a text.

    kind is ``verbatim`` or, where a slot's value was changed consistently, ``changed``. Null texts and empty tables find
    nothing; repeated rows of docs count as one text for each doc_id, and of the benchmark as one item for each text; other
    columns aren't read.
    """
    states = States(docs.sparkSession, "benchmark")
    items = states.save(benchmark_windows(benchmark, states, size), "windows")
    exploded = items.select("item", "size", F.explode("windows").alias("w")).select("item", "size", "w.hash", "w.at")
    # one pass over the small side: how many windows, and of which lengths
    facts = exploded.groupBy("size").agg(F.count_distinct("hash").alias("n")).collect()  # a row for each of at most five lengths
    lengths, small = sorted(r["size"] for r in facts), sum(r["n"] for r in facts) <= BROADCAST_WINDOWS
    texts = docs.select("doc_id", text_of().alias("text"))
    known = exploded.select("size", "hash").distinct()
    words = with_words(texts).select("doc_id", "words")
    # one pass over the texts: the windows of all lengths
    windows = F.array(*(F.struct(F.lit(n).alias("size"), windows_of(F.col("words"), n).alias("hashes")) for n in lengths or [size]))
    stands = words.select("doc_id", F.explode(windows).alias("w")).select("doc_id", "w.size", F.posexplode("w.hashes").alias("at", "hash"))
    hits = stands.join(F.broadcast(known) if small else known, ["size", "hash"], "left_semi")
    aligned = hits.join(exploded.withColumnRenamed("at", "item_at"), ["size", "hash"]).withColumn("shift", F.col("at") - F.col("item_at"))
    # an occurrence: all windows of a text and an item at one shift
    one = states.save(aligned.groupBy("doc_id", "item", "shift").agg(F.collect_set("hash").alias("hashes"), F.min("at").alias("low"), (F.max("at") + F.first("size")).alias("high")), "occurrences")
    size_of = items.select("item", F.size(F.array_distinct(F.transform("windows", lambda w: w["hash"]))).alias("n_item_windows"))
    near = one.groupBy("doc_id", "item").agg(F.size(F.array_distinct(F.flatten(F.collect_list("hashes")))).alias("n")).join(size_of, "item").filter(F.col("n") >= share * F.col("n_item_windows"))
    likely = states.save(one.join(near.select("doc_id", "item", "n_item_windows"), ["doc_id", "item"]), "likely")

    # slots of those texts and items, side by side
    ids = few(likely.select("doc_id").distinct())
    doc_slots = slots_of(with_words(texts.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])), "doc_id")
    item_slots = slots_of(items, "item")
    both = likely.join(doc_slots, "doc_id").filter((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")))
    both = both.withColumn("item_place", F.col("place") - F.col("shift")).join(item_slots.select("item", F.col("place").alias("item_place"), F.col("value").alias("item_value")), ["item", "item_place"])
    key = ["doc_id", "item", "shift"]
    pairs = both.groupBy(*key, "item_value", "value").agg(F.count("*").alias("n"))
    checked = pairs.groupBy(*key).agg(F.count("*").alias("pairs"), F.count_distinct("item_value").alias("left"), F.count_distinct("value").alias("right"), F.sum("n").alias("n_slots"), F.sum(F.when(F.col("item_value") != F.col("value"), F.col("n")).otherwise(0)).alias("n_changed"))
    fair = likely.join(checked, key, "left").filter(F.col("pairs").isNull() | ((F.col("pairs") == F.col("left")) & (F.col("pairs") == F.col("right"))))
    out = fair.groupBy("doc_id", "item", "n_item_windows").agg(F.size(F.array_distinct(F.flatten(F.collect_list("hashes")))).alias("n_windows"), F.coalesce(F.sum("n_slots"), F.lit(0)).alias("n_slots"), F.coalesce(F.sum("n_changed"), F.lit(0)).alias("n_changed"))
    out = out.filter(F.col("n_windows") >= share * F.col("n_item_windows"))
    # an item that both of its templates found is told by the one with names as slots
    first = F.min_by(F.struct("n_windows", "n_item_windows", "n_slots", "n_changed"), F.col("item.plain"))
    out = out.groupBy("doc_id", F.col("item.item_id").alias("item_id")).agg(first.alias("f")).select("doc_id", "item_id", "f.*")
    return out.select("doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"), F.col("n_item_windows").cast("long").alias("n_item_windows"), "n_slots", "n_changed", F.when(F.col("n_changed") > 0, "changed").otherwise("verbatim").alias("kind"))


def few(ids: DataFrame) -> DataFrame:
    """ids to be broadcast if there are no more than BROADCAST_IDS."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def drop_found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in whose text no item was found (rows of a null doc_id stay)."""
    found = States(docs.sparkSession, "found").save(found_items(docs, benchmark).select("doc_id").distinct(), "ids")
    return docs.join(few(found), "doc_id", "left_anti")
