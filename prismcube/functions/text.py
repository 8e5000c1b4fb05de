"""Text and semi-structured columns as expressions (O)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A roman numeral of any size.
ROMAN = r"^M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"


def standardise_text(column: str | Column, acronyms: Mapping[str, str]) -> Column:
    """Upper-case words, split at everything but letters; roman numerals and single letters go, acronyms are expanded (O1). Null stays null."""
    text = F.col(column) if isinstance(column, str) else column
    words = F.filter(F.split(F.upper(text), "[^A-Z]+"), lambda w: (F.length(w) > 1) & ~w.rlike(ROMAN))
    if acronyms:
        table = F.create_map(*(F.lit(x) for k, v in acronyms.items() for x in (k.upper(), v.upper())))
        words = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.when(text.isNotNull(), F.array_join(words, " "))


def classify_text(columns: Sequence[str], rules: Sequence[tuple[str, str, str | None]], default: str | None = None) -> Column:
    """The first rule (label, allowed pattern, denied pattern) that fits the first column, else the next column's; else the default (O2)."""
    def one(c: str) -> Column:
        out = F.lit(None).cast("string")
        for label, allow, deny in reversed(rules):
            fits = F.col(c).rlike(allow)
            out = F.when(fits & ~F.col(c).rlike(deny) if deny else fits, label).otherwise(out)
        return out

    return F.coalesce(*(one(c) for c in columns), F.lit(default).cast("string"))


def embed_text(df: DataFrame, tokens: str, vectors: DataFrame, key: str, word: str = "word", vector: str = "vector", distinct: bool = False) -> DataFrame:
    """key, embedding: the mean of the vectors of a row's tokens (those without a vector don't count) (O3)."""
    words = F.array_distinct(tokens) if distinct else F.col(tokens)
    each = df.select(key, F.explode(words).alias(word)).groupBy(key, word).agg(F.count("*").alias("_n"))
    parts = each.join(vectors.select(word, vector), word).select(key, "_n", F.posexplode(vector).alias("i", "x"))
    means = parts.groupBy(key, "i").agg((F.sum(F.col("x") * F.col("_n")) / F.sum("_n")).alias("x"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("embedding"))


def cosine(a: str | Column, b: str | Column) -> Column:
    """The cosine of two vectors; null where either is null or has no length (O3)."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), zero, lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, zero, lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def extract_xml(df: DataFrame, column: str, schema: str, out: str = "records", row_tag: str = "row") -> DataFrame:
    """A nested column from an XML text; null where it is malformed or absent."""
    parsed = F.from_xml(F.col(column), schema, {"mode": "PERMISSIVE", "rowTag": row_tag, "columnNameOfCorruptRecord": "_broken"})
    sound = F.col(column).isNotNull() & (F.trim(column) != "")
    return df.withColumn(out, F.when(sound, parsed))


def argmax_key(column: str, allow: Sequence[str] | None = None) -> Column:
    """The key of a map's largest value, the least key of several; only allowed keys count, null if none."""
    entries = F.map_entries(column)
    if allow is not None:
        entries = F.filter(entries, lambda e: e["key"].isin(*allow))
    best = F.array_max(F.transform(entries, lambda e: e["value"]))
    return F.array_min(F.transform(F.filter(entries, lambda e: e["value"] == best), lambda e: e["key"]))


def md5_hex(column: str) -> Column:
    return F.md5(F.col(column).cast("string"))


#: The five entities of XML.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;"))


def xml_escape(column: str) -> Column:
    """The five characters as entities."""
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, F.col(column))


def xml_unescape(column: str) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), reversed(ENTITIES), F.col(column))
