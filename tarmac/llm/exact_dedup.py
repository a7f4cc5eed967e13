"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of fixed size. The distinct blocks are sorted and numbered, the number is a
block's name. Then adjacent names are paired, the distinct pairs sorted and numbered in turn, until one
name is left of each text. Names are numbers of distinct values and not hashes, so two texts of the same
number of levels have the same last name if and only if they are equal.

Only the distinct blocks themselves travel with their text, once, after each task has removed its own
repeats. The blocks of a document find their names by a 128-bit fingerprint; before it is used, the
distinct blocks are counted by it, and another one is taken if two different blocks share a value.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import SPACE_RUN, empty_for_null
from tarmac.session import stored


def fingerprint(block: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(block, F.lit(2 * seed)).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b")
    )


def normalised(text: str) -> Column:
    """White-space runs as one space; null as the empty text."""
    return F.regexp_replace(empty_for_null(text), SPACE_RUN, " ")


def _blocks(text: Column, size: int) -> Column:
    """Blocks of `size` characters, in one pass over the text; an empty text is one empty block."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(cut)


def _numbered(distinct: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows sorted and numbered within their partitions; the partition leads the number."""
    return distinct.sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def _named_blocks(
    rows: DataFrame, block_chars: int, hashed: Callable[[Column, int], Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows with the fingerprints of their blocks, and the names by fingerprint, both stored."""
    seed = 0
    while True:
        kept = stored(
            rows.withColumn("keys", F.transform(_blocks(F.col("body"), block_chars), lambda b: hashed(b, seed))).drop(
                "body"
            ),
            "block-keys",
        )
        distinct = rows.select(F.explode(_blocks(F.col("body"), block_chars)).alias("block")).distinct()
        names = stored(
            _numbered(distinct, ["block"]).select(hashed(F.col("block"), seed).alias("key"), "name"), "block-names"
        )
        if names.groupBy("key").count().filter("count > 1").isEmpty():
            return kept, names
        seed += 1


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = 1024,
    hashed: Callable[[Column, int], Column] = fingerprint,
    carry: bool = False,
) -> DataFrame:
    """One row per input row: its id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when they are after every run of white space became one space; null is the empty text,
    and empty texts are equal to each other. The row with the smallest id of a group stays; rows
    without an id come last, and of rows that repeat an id, one stays. Other columns of the input
    are ignored; with `carry`, the whole input row comes back as struct `doc`. An empty table gives
    an empty result.
    """
    body = normalised(text_col)
    columns = [
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.sha2(F.encode(body, "UTF-8"), 256).alias("sha"),
    ]
    if carry:
        columns.append(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))
    rows = docs.select(*columns, body.alias("body"))
    kept, names = _named_blocks(rows, block_chars, hashed)

    longest = kept.agg(F.max(F.size("keys"))).first()[0] or 1
    current = kept.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
    current = stored(current.join(names, "key").select("row", "n", "pos", "name"), "names-0")
    ended = [current.filter("n = 1").select("row", F.lit(0).alias("level"), "name")]
    for level in range(1, math.ceil(math.log2(longest)) + 1):
        even = F.col("pos") % 2 == 0
        pairs = (
            current.filter("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.ceil(F.col("n") / 2)).cast("int").alias("n"),
                F.max(F.when(even, F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("second"),
            )
        )
        pairs = stored(pairs, "pairs")
        names = stored(_numbered(pairs.select("first", "second").distinct(), ["first", "second"]), "pair-names")
        current = pairs.join(names, ["first", "second"]).select("row", "n", "pos", "name")
        current = stored(current, f"names-{level}")
        ended.append(current.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))

    identity = stored(reduce(DataFrame.unionByName, ended).join(kept.drop("keys", "doc", "sha"), "row"), "identity")
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "row"))
    groups = identity.groupBy("level", "name").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    decided = identity.join(stored(groups, "groups"), ["level", "name"]).select(
        "row",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )
    result = kept.drop("keys").join(decided, "row")
    return result.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        "kept",
        F.col("sha").alias("text_sha256"),
        *(["doc"] if carry else []),
    )
