"""Quality rules by weak supervision (operator 7), in DataFrame functions only.

Rules vote good, bad or abstain on each text. Expectation-maximisation over the
counts of vote patterns (at most 3 ** rules of them, whatever the corpus holds)
estimates how each rule votes on good and on bad texts, and the posterior
probability of a pattern decides about all texts that have it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import saved, text_of, words_of

#: The contract's symbols and window.
SYMBOLS, WINDOW = r"[#*$%&|<>]+", 8
BAD, ABSTAIN, GOOD = -1, 0, 1
#: Rounds of estimation, the weight of the prior counts, and the share of good texts that a rule may call bad at most:
#: bad votes have wide thresholds, and without a bound two classes can't tell junk of one kind from a rule's errors.
ROUNDS, SMOOTH, FALSE_ALARMS = 50, 1.0, 0.002


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words in windows of ``size`` words that occur twice or more in the text, the first occurrence included.

    Windows are compared by 64-bit hashes within one text. Sorted by (hash, place), equal windows are neighbours; each
    place adds what its window covers beyond the next one's start.
    """
    places = F.sequence(F.lit(1), F.size(words) - (size - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) < size, F.array().cast("array<bigint>")).otherwise(hashes)


def covered(hashes: Column, size: int = WINDOW) -> Column:
    """The words that repeated windows cover, from the array of window hashes (0 where none repeats)."""
    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    last = F.size(hashes) - 1

    def count(order: Column) -> Column:
        at = lambda k: F.get(order, k)["h"]  # noqa: E731  null outside
        again = F.filter(order, lambda x, k: (x["h"] == at(k - 1)) | (x["h"] == at(k + 1)))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def total(places: Column) -> Column:
        own = F.transform(places, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(places, k + 1) - p, F.lit(size))))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x)

    # a one-element transform names the intermediate arrays, so that each is made once
    inner = F.transform(F.array(order), lambda o: F.transform(F.array(count(o)), total)[0])[0]
    return F.when((last < 1) | (F.size(F.array_distinct(hashes)) == last + 1), F.lit(0).cast("long")).otherwise(inner)


def measured(docs: DataFrame) -> DataFrame:
    """docs and the counts of the contract, with what the other rules need. A null text counts as empty."""
    text = text_of()
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    out = docs.withColumn("_words", words_of(text)).withColumn("_windows", repeated_words(F.col("_words"))).withColumn("_lines", lines)
    words = F.col("_words")
    joined = F.array_join(words, "")
    return out.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(joined).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": covered(F.col("_windows")),
        "n_distinct_words": F.size(F.array_distinct(words)).cast("long"),
        "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
        "n_lone": F.size(F.filter(words, lambda w: w == "|")).cast("long"),
    }).drop("_words", "_windows", "_lines")


def votes() -> dict[str, Column]:
    """Each rule's vote from the measures: bad, good, or nothing."""
    words, chars = F.col("n_words"), F.col("word_chars")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)

    def vote(value: Column, bad: Column | None, good: Column) -> Column:
        return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)

    symbols, upper = share(F.col("n_symbols"), chars), share(F.col("n_upper"), chars)
    lines, repeats = F.col("n_dup_lines"), share(F.col("n_repeat_words"), words)
    length, variety = share(chars, words), share(F.col("n_distinct_words"), words)
    return {
        "symbols": vote(symbols, symbols > 0.1, symbols < 0.02),
        "upper": vote(upper, upper > 0.4, upper < 0.15),
        "lines": vote(lines, lines > 5, lines == 0),
        "repeats": vote(repeats, repeats > 0.3, repeats < 0.1),
        "length": vote(length, (length < 2) | (length > 15), (length >= 3) & (length <= 10)),
        "variety": vote(variety, (words >= 50) & (variety < 0.15), variety > 0.3),
        "columns": vote(F.col("n_lone"), share(F.col("n_lone"), words) > 0.1, F.col("n_lone") == 0),
    }


def posterior(patterns: Sequence[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """The probability that a text is good, for each pattern of votes; patterns and their counts are all that is needed.

    Two classes; for each rule and class the probabilities of the three votes. The first guess takes a pattern with a bad
    vote for bad; the rounds then weigh the rules by how they agree, false alarms staying below their bound.
    """
    if not patterns:
        return {}
    rules = len(patterns[0][0])
    good = {p: 0.05 if BAD in p else 0.95 for p, _ in patterns}
    for _ in range(rounds):
        total = [SMOOTH, SMOOTH]
        seen = [[{v: SMOOTH for v in (BAD, ABSTAIN, GOOD)} for _ in range(rules)] for _ in (0, 1)]
        for p, n in patterns:
            for y, weight in ((0, n * (1 - good[p])), (1, n * good[p])):
                total[y] += weight
                for j, v in enumerate(p):
                    seen[y][j][v] += weight
        for s in seen[1]:
            rest = s[ABSTAIN] + s[GOOD]
            s[BAD] = min(s[BAD], rest * FALSE_ALARMS / (1 - FALSE_ALARMS))
        log = [[{v: math.log(c / sum(s.values())) for v, c in s.items()} for s in own] for own in seen]
        prior = [math.log(t / sum(total)) for t in total]
        for p, _ in patterns:
            bad_, good_ = (prior[y] + sum(log[y][j][v] for j, v in enumerate(p)) for y in (0, 1))
            good[p] = 1 / (1 + math.exp(min(700.0, max(-700.0, bad_ - good_))))
    return good


def judged(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs, the contract's counts, base_failed, p_good and kept; without the text if that isn't wanted.

    The measures are written to the shared folder once, then read for the patterns and for the verdicts. base_failed
    texts are never kept; the others are kept where p_good is at least one half. An empty table has no patterns and gives
    no rows; columns of docs that bear a name of these are replaced.
    """
    made = [*RESULT, "p_good", "kept", "base_failed", "_pattern"]
    base = measured(docs.select(*(docs[c] for c in docs.columns if c not in made)))
    base = base if keep_text else base.drop("text")
    base = base.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    voted = saved(base.withColumn("_pattern", F.concat_ws(",", *(v.cast("string") for v in votes().values()))), "quality")
    counts = [(tuple(map(int, r["_pattern"].split(","))), r["count"]) for r in voted.groupBy("_pattern").count().collect()]  # at most 3 ** rules
    good = [(",".join(map(str, p)), v) for p, v in posterior(sorted(counts)).items()]
    verdicts = F.broadcast(docs.sparkSession.createDataFrame(good, "_pattern string, p_good double"))
    return voted.join(verdicts, "_pattern", "left").withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5)).drop("_pattern")


#: The contract's columns and the measures that the other rules use.
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_lone")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the contract's counts, base_failed, kept, p_good of every row."""
    return judged(docs.select("doc_id", "text"), keep_text=False).select("doc_id", *RESULT[:5], "base_failed", "kept", "p_good")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text is kept, with the columns of docs."""
    return judged(docs).filter("kept").select(*docs.columns)
