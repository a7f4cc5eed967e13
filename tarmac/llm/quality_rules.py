"""Quality rules whose limits follow the data.

A limit is not a fixed number but comes from the quartiles of a rate among the documents of the same
language and source. Quartiles come from sketches: counts per bucket, where a bucket holds the values
that agree in their leading six binary digits, so an edge is at most 1/32 below its values. Sketches
are merged by adding counts, whatever the partitions, and a group with few documents takes the
sketch of its language, or of all documents. Everything is whole numbers, so results never depend on the
order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import SPACE_CHARS, SPACE_RUN, empty_for_null, indexes, with_value, words
from tarmac.session import stored

#: Characters that count as symbols (a fixed value).
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rate:
    """A rate in whole numbers, the least spread it is judged by, and the sides that are judged."""

    name: str
    numerator: str
    denominator: str
    scale: int
    least_spread: int
    low: bool = False


RATES = (
    Rate("symbol_rate", "n_symbols", "word_chars", 1000, 30),
    Rate("repeat_rate", "n_repeat_words", "n_words", 1000, 100),
    Rate("dup_line_rate", "n_dup_lines", "n_lines", 1000, 150),
    Rate("word_length", "word_chars", "n_words", 100, 60, low=True),
)
#: A limit lies this many spreads beyond the quartile.
SPREADS = 3
#: Groups of fewer documents take the sketch of the next larger group.
MIN_DOCUMENTS = 200


def measured(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Columns lang, source, the counts, and the input row as struct `doc`."""
    text = F.col("body")
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        empty_for_null(text_col).alias("body"),
    )
    w = F.col("w")
    rows = with_value(rows, "w", words(text))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    # A window of three words by its 64-bit hash: within one text, equal hashes mean equal words.
    windows = F.transform(
        indexes(F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    rows = with_value(rows, "lines", lines)
    rows = with_value(rows, "windows", windows).select(
        "doc",
        "lang",
        "source",
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE_RUN, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        "lines",
        "windows",
    )
    windows = F.col("windows")
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    tagged = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumns(
        {
            "n_lines": F.size("lines").cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        }
    )
    rows = with_value(rows, "sorted", F.when(repeats, tagged)).drop("lines", "windows")
    s = F.col("sorted")
    same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
    again = F.filter(s, lambda x, j: F.coalesce(same(x, j), F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
    covered = F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    n_repeat = F.when(s.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered)))
    return with_value(rows, "n_repeat_words", n_repeat.cast("bigint")).drop("sorted")


def rate_value(rate: Rate) -> Column:
    """The rate as a whole number, null where it has no denominator."""
    over = F.col(rate.denominator)
    return F.when(over > 0, F.floor(F.col(rate.numerator) * rate.scale / over)).cast("bigint")


def _bucket(value: Column) -> Column:
    """Values below 64 as they are; above, the lowest value with the same leading six binary digits."""
    digits = F.length(F.bin(value))
    cut = F.greatest(digits - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(rows: DataFrame) -> DataFrame:
    """Counts by lang, source, rate and bucket: the mergeable sketch of each group and rate."""
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rate"), rate_value(r).alias("value")) for r in RATES]))
    values = rows.select("lang", "source", each.alias("x")).filter("x.value IS NOT NULL")
    return (
        values.select("lang", "source", F.col("x.rate").alias("rate"), _bucket(F.col("x.value")).alias("bucket"))
        .groupBy("lang", "source", "rate", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Documents and quartiles of each group and rate; a sketch has a bounded number of buckets."""
    merged = sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rate")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(group))
    return ranked.groupBy(*keys, "rate").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"),
    )


def limits(sketch: DataFrame, min_documents: int = MIN_DOCUMENTS, spreads: int = SPREADS) -> DataFrame:
    """One row per language and source with `<rate>_high` and, where judged, `<rate>_low`."""
    own = _quartiles(sketch, ["lang", "source"])
    lang = _quartiles(sketch, ["lang"]).select(
        "lang", "rate", F.col("total").alias("total_2"), F.struct("q1", "q3").alias("of_lang")
    )
    every = _quartiles(sketch, []).select("rate", F.struct("q1", "q3").alias("of_all"))
    same_lang = own["lang"].eqNullSafe(lang["lang"]) & (own["rate"] == lang["rate"])
    joined = own.join(lang, same_lang, "left").select(own["*"], "total_2", "of_lang").join(every, "rate")
    q = (
        F.when(F.col("total") >= min_documents, F.struct("q1", "q3"))
        .when(F.col("total_2") >= min_documents, F.col("of_lang"))
        .otherwise(F.col("of_all"))
    )
    joined = joined.select("lang", "source", "rate", q.alias("q"))
    columns = []
    for r in RATES:
        this = F.col("rate") == r.name
        spread = F.greatest(F.col("q.q3") - F.col("q.q1"), F.lit(r.least_spread)) * spreads
        columns.append(F.max(F.when(this, F.col("q.q3") + spread)).alias(f"{r.name}_high"))
        if r.low:
            columns.append(F.max(F.when(this, F.col("q.q1") - spread)).alias(f"{r.name}_low"))
    return joined.groupBy("lang", "source").agg(*columns)


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    spreads: int = SPREADS,
) -> DataFrame:
    """The input row as struct `doc`, its counts, the limits of its group, `base_failed` and `kept`.

    Null text has no words. A text without words has no rates; it fails the base rule. Null language
    or source is a group of its own. Repeated rows count each time. An empty table gives an empty result.
    The base rule rejects fewer than 50 words, or more than half of the words in repeated
    windows; the method rejects a rate beyond the limits of the document's language and source.
    """
    rows = measured(docs, text_col, lang_col, source_col)
    table = stored(limits(stored(sketches(rows), "sketches"), min_documents, spreads), "limits")
    table = table.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    group = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    joined = rows.join(table, group, "left").drop("of_lang", "of_source")
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    outside = F.lit(False)
    for r in RATES:
        value = rate_value(r)
        outside = outside | F.coalesce(value > F.col(f"{r.name}_high"), F.lit(False))
        if r.low:
            outside = outside | F.coalesce(value < F.col(f"{r.name}_low"), F.lit(False))
    return joined.withColumn("base_failed", base).withColumn("kept", ~base & ~outside)
