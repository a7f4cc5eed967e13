"""Secret scan: fixed patterns, and strings that look random to two character Markov models.

One model learns random strings, the other ordinary words; both are counts of character pairs from
labelled samples. A string is a finding when the log-likelihood ratio of the two is high enough. Both
models have one count per pair of characters of a fixed alphabet, so their size is bounded by the
alphabet whatever the corpus; log ratios are rounded to thousandths, so the sum has no order.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import CHUNK, before_chunks, chunk_totals, empty_for_null, indexes, total_before, with_value

#: Fixed patterns by kind, in the order in which kinds are listed.
ASSIGN = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Runs of one class that are long enough: the same matches as any run, short ones dropped.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
PATTERNS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))
MIN_VALUE = 6

#: Characters of the strings that are judged. A state is a character's code; 0 is the start of a string.
ALPHABET_SIZE = 67
STATES = 128
MIN_CANDIDATE = 16
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{MIN_CANDIDATE},}}"
ORDINARY = r"[A-Za-z0-9+/_=-]{4,}"
#: Thousandths of the natural logarithm of the ratio that make a finding.
MIN_RATIO = 12_000


def with_spans(rows: DataFrame, body: str, patterns: list[tuple[int, str, str]], name: str) -> DataFrame:
    """All leftmost non-overlapping matches per pattern (rank, kind, pattern) as (start, rank, kind, end, value), sorted.

    Matches, their steps through the text and the running totals are columns of their own before a lambda uses them.
    """
    each = lambda value: F.struct(*[value(kind, pattern).alias(kind) for _, kind, pattern in patterns])
    text, columns = F.col(body), rows.columns

    def step(kind: str, pattern: str) -> Column:
        found = F.col(f"found.{kind}")
        none = F.array().cast("array<string>")
        between = F.slice(F.when(F.size(found) > 0, F.split(text, pattern)).otherwise(none), F.lit(1), F.size(found))
        return F.zip_with(between, found, lambda p, m: (F.length(p) + F.length(m)).cast("bigint"))

    def value(kind: str, pattern: str) -> Column:
        found = F.col(f"found.{kind}")
        return F.when(F.size(found) > 0, F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).otherwise(found)

    def spans(rank: int, kind: str) -> Column:
        found, steps, before = (F.col(f"{c}.{kind}") for c in ("found", "steps", "before"))
        values = F.col(f"values.{kind}") if kind == "assign" else found

        def span(i: Column) -> Column:
            end = total_before(steps, before, i) + F.get(steps, i)
            start = end - F.length(F.get(found, i))
            own = (F.lit(rank).alias("rank"), F.lit(kind).alias("kind"))
            return F.struct(start.alias("start"), *own, end.alias("end"), F.get(values, i).alias("value"))

        all_ = F.transform(indexes(F.size(found)), span)
        return F.filter(all_, lambda s: F.length(s["value"]) >= MIN_VALUE) if kind == "assign" else all_

    rows = with_value(rows, "found", each(lambda _, pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    if any(kind == "assign" for _, kind, _ in patterns):
        rows = with_value(rows, "values", each(lambda kind, p: value(kind, p) if kind == "assign" else F.lit(None)))
    rows = with_value(rows, "steps", each(step))
    rows = with_value(rows, "totals", each(lambda kind, _: chunk_totals(F.col(f"steps.{kind}"))))
    rows = with_value(rows, "before", each(lambda kind, _: before_chunks(F.col(f"totals.{kind}"))))
    rows = with_value(rows, name, F.sort_array(F.concat(*[spans(rank, kind) for rank, kind, _ in patterns])))
    return rows.select(*columns, name)


def with_runs(rows: DataFrame, spans: str, name: str) -> DataFrame:
    """Spans, sorted by start, joined to (start, end) pairs that neither overlap nor touch, as column `name`.

    A run begins where a span starts behind all ends ahead of it; the greatest end ahead comes from chunks.
    """
    columns, ends, tops, before, begins = rows.columns, F.col("_ends"), F.col("_tops"), F.col("_before"), F.col("_begins")
    n = F.size(spans)

    def ahead(i: Column) -> Column:
        chunk = F.floor(i / CHUNK).cast("int")
        return F.greatest(F.get(before, chunk), F.array_max(F.slice(ends, chunk * CHUNK + 1, i % CHUNK)))

    def begins_run(i: Column) -> Column:
        return F.coalesce(F.get(F.col(spans), i)["start"] > ahead(i), F.lit(True))

    def run(j: Column) -> Column:
        end = F.coalesce(ahead(F.get(begins, j + 1)), F.array_max(ends))
        return F.struct(F.get(F.col(spans), F.get(begins, j))["start"].alias("start"), end.alias("end"))

    chunks = indexes(F.ceil(n / CHUNK))
    rows = with_value(rows, "_ends", F.transform(spans, lambda s: s["end"]))
    rows = with_value(rows, "_tops", F.transform(chunks, lambda c: F.array_max(F.slice(ends, c * CHUNK + 1, F.lit(CHUNK)))))
    up_to = F.transform(indexes(F.size(tops)), lambda c: F.array_max(F.slice(tops, F.lit(1), c)))
    rows = with_value(rows, "_before", up_to)
    rows = with_value(rows, "_begins", F.filter(indexes(n), begins_run))
    return with_value(rows, name, F.transform(indexes(F.size(begins)), run)).select(*columns, name)


def with_masked(rows: DataFrame, body: str, spans: str, mask: str, name: str) -> DataFrame:
    """The text with the union of the spans replaced, as column `name`.

    The parts between are cut in two steps, as finding a place in a text takes as long as the text ahead of it.
    """
    runs, text = F.col("_runs"), F.col(body)
    begin = lambda i: F.coalesce(F.get(runs, i - 1)["end"], F.lit(0)).cast("int")
    end = lambda i: F.coalesce(F.get(runs, i)["start"].cast("int"), F.length(body))
    parts = F.size(runs) + 1

    def piece(g: Column) -> Column:
        first, stop = g * CHUNK, F.least((g + 1) * CHUNK, parts)
        cut = F.substring(text, begin(first) + 1, end(stop - 1) - begin(first))
        return F.struct(first.alias("first"), stop.alias("stop"), begin(first).alias("at"), cut.alias("text"))

    def cuts(x: Column) -> Column:
        places = F.sequence(x["first"], x["stop"] - 1)
        return F.transform(places, lambda i: F.substring(x["text"], begin(i) - x["at"] + 1, end(i) - begin(i)))

    between = F.flatten(F.transform(F.transform(indexes(F.ceil(parts / CHUNK)), piece), cuts))
    whole = F.when(F.size(runs) == 0, text).otherwise(F.array_join(between, mask))
    return with_value(with_runs(rows, spans, "_runs"), name, whole).drop("_runs")


def labelled_samples(rows: DataFrame) -> DataFrame:
    """Strings with label and count: values that the fixed patterns found, and all other long enough words."""
    secret = rows.select(F.explode(F.transform("base", lambda s: s["value"])).alias("value"), F.lit(True).alias("random"))
    rest = with_masked(rows.select("body", "base"), "body", "base", " ", "rest")
    word = F.explode(F.regexp_extract_all("rest", F.lit(ORDINARY), F.lit(0)))
    ordinary = rest.select(word.alias("value"), F.lit(False).alias("random"))
    return secret.unionByName(ordinary).groupBy("value", "random").agg(F.count(F.lit(1)).alias("n"))


def _codes(value: Column) -> Column:
    """Character codes after a leading 0."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(value, ""), lambda c: F.ascii(c)))


def train(samples: DataFrame) -> list[int]:
    """Log ratios in thousandths for each pair of states, from labelled strings (value, random, n).

    The pairs counted are at most two per pair of characters of the alphabet, so they fit the driver.
    Without samples of a label all characters are equally likely under it. Null and empty strings say nothing;
    characters outside ASCII are left out.
    """
    pairs = with_value(samples.filter(F.length("value") > 0), "codes", _codes(F.col("value")))
    codes = F.col("codes")
    pair = F.transform(indexes(F.size(codes) - 1), lambda i: F.get(codes, i) * STATES + F.get(codes, i + 1))
    counts = (
        pairs.select("random", "n", F.explode(pair).alias("pair"))
        .filter(F.col("pair").between(0, STATES * STATES - 1))
        .groupBy("random", "pair")
        .agg(F.sum("n").alias("n"))
    )
    seen: dict[bool, list[int]] = {True: [0] * STATES**2, False: [0] * STATES**2}
    for r in counts.collect():
        seen[r["random"]][r["pair"]] = r["n"]
    ratios = []
    for first in range(STATES):
        row = slice(first * STATES, (first + 1) * STATES)
        total = {label: sum(n[row]) + ALPHABET_SIZE for label, n in seen.items()}
        for random, ordinary in zip(seen[True][row], seen[False][row], strict=True):
            ratio = math.log((random + 1) / total[True]) - math.log((ordinary + 1) / total[False])
            ratios.append(math.floor(1000 * ratio + 0.5))
    return ratios


def log_ratio(codes: Column, model: list[int]) -> Column:
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<bigint>")
    step = lambda acc, i: acc + F.get(table, F.get(codes, i) * STATES + F.get(codes, i + 1))
    return F.aggregate(indexes(F.size(codes) - 1), F.lit(0).cast("bigint"), step)


def _rows(docs: DataFrame, text_col: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), empty_for_null(text_col).alias("body"))
    return with_spans(rows, "body", [(i, *p) for i, p in enumerate(PATTERNS)], "base")


def _first(n: Column, test: Callable[[Column], Column]) -> Column:
    """The least of 0 to n - 1 that passes a test which all after it pass as well; n if none does."""
    halve = lambda acc: F.shiftright(acc["lo"] + acc["hi"], 1)

    def step(acc: Column, _: Column) -> Column:
        mid, open_ = halve(acc), acc["lo"] < acc["hi"]
        passed = open_ & F.coalesce(test(mid), F.lit(True))
        lo = F.when(open_ & ~passed, mid + 1).otherwise(acc["lo"])
        return F.struct(lo.alias("lo"), F.when(passed, mid).otherwise(acc["hi"]).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), step, lambda acc: acc["lo"])


def _inside(span: Column, runs: Column) -> Column:
    """The runs that share a place with a span, found by halving: runs are sorted and apart."""
    first = _first(F.size(runs), lambda i: F.get(runs, i)["end"] > span["start"])
    stop = _first(F.size(runs), lambda i: F.get(runs, i)["start"] >= span["end"])
    found = F.slice(runs, first + 1, F.greatest(stop - first, F.lit(0)))
    return F.when(F.size(runs) == 0, runs).otherwise(found)


def _outside(span: Column, inside: Column) -> Column:
    """What is left of a span without the runs inside it, in parts that are long enough to be judged."""
    starts = F.concat(F.array(span["start"]), F.transform(inside, lambda r: r["end"]))
    ends = F.concat(F.transform(inside, lambda r: r["start"]), F.array(span["end"]))

    def part(start: Column, end: Column) -> Column:
        value = F.substring(span["value"], (start - span["start"] + 1).cast("int"), (end - start).cast("int"))
        own = [span["rank"].alias("rank"), span["kind"].alias("kind")]
        return F.struct(start.alias("start"), *own, end.alias("end"), value.alias("value"))

    return F.filter(F.zip_with(starts, ends, part), lambda s: s["end"] - s["start"] >= MIN_CANDIDATE)


def find_secrets(
    docs: DataFrame, text_col: str = "text", model: list[int] | None = None, min_ratio: int = MIN_RATIO
) -> DataFrame:
    """The input row as struct `doc`, its text as `body`, `base` (spans of the fixed patterns) and `spans` (all).

    Spans are (start, rank, kind, end, value), in code points, end exclusive, by start and then kind.
    Spans of the fixed patterns are not judged again; what a string has outside them is, by parts. Without a model one is
    trained from the documents. Null text is empty and has no spans. Repeated rows each get their
    spans. An empty table gives an empty result.
    """
    rows = _rows(docs, text_col)
    if model is None:
        model = train(labelled_samples(rows))
    judged = with_spans(rows, "body", [(len(PATTERNS), "markov", CANDIDATE)], "long")
    base, runs = F.col("base"), F.col("base_runs")
    judged = with_runs(judged, "base", "base_runs")
    placed = F.transform("long", lambda s: F.struct(s.alias("span"), _inside(s, runs).alias("inside")))
    free = F.flatten(F.transform(placed, lambda x: _outside(x["span"], x["inside"])))
    coded = F.transform(free, lambda s: F.struct(s.alias("span"), _codes(s["value"]).alias("codes")))
    judged = with_value(judged, "coded", coded)
    found = F.filter("coded", lambda x: log_ratio(x["codes"], model) >= min_ratio)
    spans = F.sort_array(F.concat(base, F.transform(found, lambda x: x["span"])))
    return with_value(judged.select("doc", "body", "base", "coded"), "spans", spans).drop("coded")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "<secret>", **options) -> DataFrame:
    """The same rows and columns, each finding of the text replaced by the mask; null text stays null."""
    found = with_masked(find_secrets(docs, text_col, **options), "body", "spans", mask, "clean")
    text = F.when(F.col(f"doc.{text_col}").isNotNull(), F.col("clean"))
    return found.select(*[text.alias(c) if c == text_col else F.col(f"doc.{c}").alias(c) for c in docs.columns])


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
