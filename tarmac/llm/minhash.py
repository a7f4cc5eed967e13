"""Near-duplicates by HyperMinHash.

A document's shingle hashes fall into 256 buckets; a bucket keeps of its smallest hash the number of leading
zeros (6 bits) and ten bits after the leading one. An empty bucket takes over the register of the first filled
bucket in an order of its own, the same for all documents. Bands of five registers bring candidates together:
51 bands miss a pair at similarity 0.8 with a probability of 2e-9. Candidates are first judged by their
registers (agreements less those expected by chance), then by their full sets.

A bucket of many documents never becomes all its pairs. First each document is held against the
smallest document it meets in any band. What is linked then needs no further pair. Documents in buckets that still
hold several components are put into clusters, each with the most similar smallest document of its buckets. A cluster
is settled by the consensus of its sets, the shingles that over half of the members hold: a member X lacks
m of the c consensus shingles and adds d others, and a pair is a link exactly if
`180 * shared >= cost(X) + cost(Y) - 20 * c`, with cost = 100 * m + 80 * d and `shared` the lacking and added
shingles that both have in common. So

* members whose cost and the least cost are within 20 * c are linked with the member of least cost, unseen;
* a pair without a common added shingle shares at most the smaller m: whether that could do is decided once per two
  classes of equal (m, d), and only members of classes that could meet;
* any other link has enough added shingles in common that one is among the rarest of both (a prefix filter).

That costs no pair per two members of a group of near copies, however large, unless their lengths or additions bring them together.
Buckets whose members are in several clusters then go on, small ones by their pairs across clusters. In a large one,
the members outside its largest component are held against those of other clusters, some at a time; the component is chosen
once per bucket. As one less the similarity is a distance, two members whose
distances to the bucket's smallest member differ by more than a link allows need not meet; the estimates get a
margin for their error. So no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import empty_for_null
from tarmac.llm.components import merge_components
from tarmac.llm.hashing import group_starts, joined, mix, slices, word_hashes
from tarmac.session import stored

BUCKETS = 256
BAND_ROWS = 5
BANDS = BUCKETS // BAND_ROWS
MANTISSA_BITS = 10
#: A link needs 100 * intersection >= LINK * union.
LINK = 80
#: Pairs whose estimate is below are not verified. Registers of a linked pair agree in 80 % with a
#: standard deviation of at most 4 %, so this is six of them away.
LEAST_ESTIMATE = 0.55
#: Documents join the cluster of another from this estimate on. Where clusters end has no influence on the links.
CLUSTER_ESTIMATE = 0.2
#: Buckets up to this size are settled by their pairs.
SMALL_BUCKET = 8
#: Members whose estimated similarities to a third differ by more can't be linked: 0.2 and twice four deviations.
LARGEST_DIFFERENCE = 0.52
#: Members of a large bucket that are held against the others in the first round, and their growth per round.
FIRST_HUBS, HUB_GROWTH = 16, 16

_orders: list[np.ndarray] = []


def _order() -> np.ndarray:
    """For each register the places of all buckets in its own fixed order."""
    if not _orders:
        random = np.random.default_rng(20240229)
        _orders.append(np.argsort(random.random((BUCKETS, BUCKETS)), axis=1).astype(np.int16))
    return _orders[0]


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order of row and hash, and their rows. Fewer words than `width` are one shingle."""
    words, row = word_hashes(data, offsets, lower=True)
    if not len(words):
        return words, row
    n = np.bincount(row, minlength=len(offsets) - 1)
    hashes, length = words, 1
    for _ in range(width - 1):
        hashes = joined(hashes[:-1], words[length:])
        length += 1
    whole = row[: len(hashes)] == row[len(words) - len(hashes) :]
    hashes, rows = hashes[whole], row[: len(whole)][whole]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        first = np.searchsorted(row, short)
        own = words[first]
        for k in range(1, width - 1):
            more = n[short] > k
            own[more] = joined(own[more], words[first[more] + k])
        own = mix(own + n[short].astype(np.uint64))
        hashes, rows = np.concatenate([hashes, own]), np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def registers(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """One row of 256 compressed registers per document; zeros for a document without shingles."""
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    first = group_starts(rows * BUCKETS + bucket)
    least = (hashes[first] & np.uint64((1 << 56) - 1)) >> np.uint64(3)
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.where(least > 0, 53 - exponent, 53)
    mantissa = np.where(least > 0, np.floor((fraction - 0.5) * 2 * (1 << MANTISSA_BITS)), 0)
    out = np.zeros((n_rows, BUCKETS), np.uint16)
    filled = np.zeros((n_rows, BUCKETS), bool)
    at = (rows[first], bucket[first])
    out[at] = (zeros.astype(np.int64) << MANTISSA_BITS | mantissa.astype(np.int64)).astype(np.uint16)
    filled[at] = True
    order = _order()
    n_filled = filled.sum(axis=1)
    for d in np.flatnonzero((n_filled > 0) & (n_filled < BUCKETS)):
        full, empty = np.flatnonzero(filled[d]), np.flatnonzero(~filled[d])
        out[d, empty] = out[d, full[order[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "body"):
            hashes, row = shingles(data, offsets, width)
            n = np.bincount(row, minlength=rows.num_rows)
            some = np.flatnonzero(n)
            marks = np.zeros((2, rows.num_rows), np.uint64)
            first = group_starts(row)
            if len(first):
                marks[0, some] = np.add.reduceat(mix(hashes), first)
                marks[1, some] = np.bitwise_xor.reduceat(mix(hashes ^ np.uint64(0xA0761D6478BD642F)), first)
            sketch = registers(hashes, row, rows.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(n.astype(np.int64)),
                    pa.array(marks[0].view(np.int64)),
                    pa.array(marks[1].view(np.int64)),
                    pa.array([r.tobytes() for r in sketch], pa.binary()),
                ],
                names=["id", "n_shingles", "mark", "mark_2", "registers"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "body"):
            hashes, row = shingles(data, offsets, width)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists], names=["id", "shingles"])

    return run


def chance_agreement(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that a register of two sets of n and m other elements agrees by chance."""
    zeros = np.arange(1, 54)[:, None]
    below, above = np.ldexp(1.0, -zeros), np.ldexp(1.0, 1 - zeros)
    share = lambda k: np.exp(-k / BUCKETS * below) - np.exp(-k / BUCKETS * above)
    return (share(n) * share(m)).sum(axis=0) / (1 << MANTISSA_BITS)


def _estimated(least: float):
    """Pairs (a, b) with their corrected estimate, where it reaches the least one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                a, b, n, m, x, y = (part.column(i) for i in range(6))
                x = np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, BUCKETS)
                y = np.frombuffer(b"".join(y.to_pylist()), np.uint16).reshape(-1, BUCKETS)
                chance = chance_agreement(n.to_numpy().astype(float), m.to_numpy().astype(float))
                estimate = ((x == y).mean(axis=1) - chance) / (1 - chance)
                keep = pa.array(estimate >= least)
                columns = [a.filter(keep), b.filter(keep), pa.array(estimate).filter(keep)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "estimate"])

    return run


class _Verifier:
    """Holds the tables that pairs are checked against."""

    def __init__(self, sketches: DataFrame, sets: DataFrame):
        self.sketches, self.sets = sketches, sets
        self.kind = dict(sketches.dtypes)["id"]

    def estimates(self, pairs: DataFrame, least: float) -> DataFrame:
        side = lambda name: [F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n_shingles", "registers")]]
        both = pairs.join(self.sketches.select(*side("a")), "a").join(self.sketches.select(*side("b")), "b")
        both = both.select("a", "b", "n_shingles_a", "n_shingles_b", "registers_a", "registers_b")
        return both.mapInArrow(_estimated(least), f"a {self.kind}, b {self.kind}, estimate double")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links by their full sets."""
        side = lambda name: [F.col("id").alias(name), F.col("shingles").alias(f"shingles_{name}")]
        likely = stored(self.estimates(pairs, LEAST_ESTIMATE).select("a", "b"), "likely")
        full = likely.join(self.sets.select(*side("a")), "a").join(self.sets.select(*side("b")), "b")
        shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
        union = F.size("shingles_a") + F.size("shingles_b") - shared
        return stored(full.filter(shared * 100 >= union * LINK).select("a", "b"), "links")


def _bands(sketches: DataFrame) -> DataFrame:
    each = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * (2 * BAND_ROWS) + 1, F.lit(2 * BAND_ROWS))),
    )
    return sketches.select("id", F.explode(each).alias("key"))


def _clusters(nodes: DataFrame, rays: DataFrame) -> DataFrame:
    """Clusters (node, cluster): each node goes to the most similar of the smaller nodes it was held against."""
    best = F.max_by("hub", F.struct("estimate", "hub")).alias("a")
    parents = rays.filter(F.col("estimate") >= CLUSTER_ESTIMATE).groupBy(F.col("id").alias("b")).agg(best)
    start = nodes.select("node", F.col("node").alias("label"))
    return merge_components(start, stored(parents, "parents")).withColumnRenamed("label", "cluster")


def _coded(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """Members by their difference from the consensus of their cluster: `m`, `d`, `cost`, what `least` other cost
    settles them with the member `centre`, and `added`, the rarest added shingles by which links must meet."""
    of = clusters.withColumnRenamed("node", "id")
    members = of.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    each = of.join(sets, "id").select("cluster", "id", F.explode("shingles").alias("x"))
    counts = each.groupBy("cluster", "x").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts.join(members, "cluster").withColumn("core", F.col("n") * 2 > F.col("members")), "consensus")
    core = counts.filter("core").groupBy("cluster").agg(F.count(F.lit(1)).alias("c"))
    # Consensus shingles are few and held by nearly all, so they are counted before the others are listed.
    flagged = each.join(counts.select("cluster", "x", "n", "core"), ["cluster", "x"])
    own = flagged.groupBy("cluster", "id").agg(
        F.count_if("core").alias("held"),
        F.array_sort(F.collect_list(F.when(~F.col("core"), F.struct("n", "x")))).alias("all_added"),
    )
    own = own.join(core, "cluster", "left").withColumns({"c": F.coalesce("c", F.lit(0)), "d": F.size("all_added")})
    own = own.withColumn("m", F.col("c") - F.col("held"))
    own = stored(own.withColumn("cost", F.col("m") * 100 + F.col("d") * 80).drop("held"), "differences")
    ends = own.groupBy("cluster").agg(
        F.min(F.struct("cost", "id")).alias("centre"), F.max(F.col("m") - F.col("d")).alias("shortest")
    )
    own = own.join(ends, "cluster").withColumn("sure", F.col("cost") + F.col("centre.cost") <= F.col("c") * 20)
    # Common additions that a link needs at least, with any partner.
    needed = F.greatest(F.lit(1), F.ceil((F.col("cost") - F.col("c") * 20 - F.col("shortest") * 80) / 180))
    first = F.greatest(F.lit(0), F.col("d") - needed + 1).cast("int")
    added = F.transform(F.filter(F.slice("all_added", F.lit(1), first), lambda e: e["n"] > 1), lambda e: e["x"])
    columns = ["cluster", "id", "c", "m", "d", "cost", "sure", F.col("centre.id").alias("centre"), added.alias("added")]
    return stored(own.select(*columns), "coded")


def _across(a: DataFrame, b: DataFrame, on: list[str], could) -> DataFrame:
    """Pairs (a, b) of the unsettled members of `a` with other members of `b`, each pair from one of its sides."""
    names = ["id", "c", "m", "d", "cost", "sure", "label"]
    side = lambda t, n: t.select(*on, *[F.col(c).alias(f"{c}_{n}") for c in names])
    both = side(a.filter("NOT sure"), "a").join(side(b, "b"), on)
    both = both.filter((F.col("label_a") != F.col("label_b")) & (F.col("sure_b") | (F.col("id_a") < F.col("id_b"))))
    both = both.filter(could(*[F.least(f"{c}_a", f"{c}_b") for c in ("m", "d")]))
    return both.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def _within_clusters(clusters: DataFrame, labels: DataFrame, verifier: _Verifier) -> DataFrame:
    """Labels after all links within clusters, by the members' differences from their cluster's consensus."""
    known = clusters.join(labels, "node")
    several = known.groupBy("cluster").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    several = stored(clusters.join(several.select("cluster"), "cluster").select("node", "cluster"), "clusters")
    if several.isEmpty():
        return labels
    coded = _coded(several, verifier.sets)
    sure = coded.filter("sure AND id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    labels = merge_components(labels, sure)
    coded = stored(coded.join(labels.withColumnRenamed("node", "id"), "id"), "labelled")

    excess = F.col("cost_a") + F.col("cost_b") - F.col("c_a") * 20
    listed = coded.withColumn("x", F.explode("added"))
    sharing = _across(listed, listed, ["cluster", "x"], lambda m, d: excess <= (m + d) * 180)

    # Without a common addition only the lacking shingles count, so it depends on the classes of sizes alone.
    classes = coded.groupBy("cluster", "c", "m", "d", "cost").agg(F.bool_and("sure").alias("sure"))
    one = lambda n: [F.col(k).alias(f"{k}_{n}") for k in ("c", "m", "d", "cost", "sure")]
    could = classes.filter("NOT sure").select("cluster", *one("a")).join(classes.select("cluster", *one("b")), "cluster")
    could = could.filter(excess <= F.least("m_a", "m_b") * 180)
    could = could.select("cluster", *[F.col(k) for k in ("m_a", "d_a", "m_b", "d_b")])
    pick = lambda n: coded.select("cluster", *[F.col(k).alias(f"{k}_{n}") for k in ("m", "d", "id", "label", "sure")])
    sized = could.join(pick("a"), ["cluster", "m_a", "d_a"]).join(pick("b"), ["cluster", "m_b", "d_b"])
    sized = sized.filter((F.col("label_a") != F.col("label_b")) & (F.col("sure_b") | (F.col("id_a") < F.col("id_b"))))
    sized = sized.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
    return merge_components(labels, verifier.links(sharing.union(sized).distinct()))


def _settled(
    members: DataFrame, labels: DataFrame, verifier: _Verifier, small: int, rays: DataFrame | None = None,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """Labels after all buckets (key, id, size, hub) hold one component or one cluster each or had all their pairs
    across clusters judged. Without `clusters` each member is its own; `rays` are known estimates (hub, id, estimate)."""
    own = F.col("id").alias("cluster")
    clustered = members.select("*", own) if clusters is None else members.join(clusters.withColumnRenamed("node", "id"), "id")

    def mixed(of: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with the bucket's largest component as `main`."""
        sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("of_label"))
        known = of.join(labels.withColumnRenamed("node", "id"), "id").join(sizes, "label")
        main = F.max(F.struct("of_label", "label"))["label"].alias("main")
        ends = [f(c).alias(n) for c, x, y in (("label", "x", "y"), ("cluster", "p", "q")) for f, n in ((F.min, x), (F.max, y))]
        several = known.groupBy("key").agg(*ends, main).filter("x <> y AND p <> q")
        return stored(known.drop("of_label").join(several.select("key", "main"), "key"), "mixed")

    open_ = mixed(clustered)
    few = open_.filter(F.col("size") <= small)
    side = lambda n: few.select("key", *[F.col(c).alias(f"{c}_{n}") for c in ("id", "label", "cluster")])
    pairs = side("a").join(side("b"), "key").filter("id_a < id_b AND label_a <> label_b AND cluster_a <> cluster_b")
    labels = merge_components(labels, verifier.links(pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()))

    large = open_.filter(F.col("size") > small)
    if large.isEmpty():
        return labels
    if rays is None:
        rays = _rays(large, verifier)
    large = large.drop("label", "main").join(rays, ["hub", "id"], "left")
    # A place in the bucket by hash: rounds take the members with places up to a bound, without sorting any.
    place = F.pmod(F.xxhash64("key", "id"), F.col("size"))
    large = stored(large.withColumns({"estimate": F.coalesce("estimate", F.lit(1.0)), "place": place}), "large")
    done, upto, fixed = 0, FIRST_HUBS, None
    while True:
        open_ = mixed(large.filter(F.col("size") > done))
        # A bucket keeps the component that was largest at first, by one of its members, through all merges:
        # a member that was no hub in its round belongs to this component from then on.
        if fixed is None:
            fixed = stored(open_.filter("label = main").groupBy("key").agg(F.min("id").alias("node")), "main-members")
        main = fixed.join(labels, "node").select("key", F.col("label").alias("main"))
        open_ = open_.drop("main").join(main, "key")
        hubs = open_.filter((F.col("label") != F.col("main")) & (F.col("place") >= done) & (F.col("place") < upto))
        if open_.isEmpty():
            return labels
        columns = ["id", "label", "cluster", "estimate"]
        a = hubs.select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
        b = open_.select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
        apart = F.abs(F.col("estimate_a") - F.col("estimate_b")) > LARGEST_DIFFERENCE
        other = (F.col("label_a") != F.col("label_b")) & (F.col("cluster_a") != F.col("cluster_b"))
        star = a.join(b, (a["key"] == b["key"]) & other & ~apart)
        star = star.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
        labels = merge_components(labels, verifier.links(star))
        done, upto = upto, upto * HUB_GROWTH


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components."""
    known = members.join(labels.withColumnRenamed("node", "id"), "id")
    several = known.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    return stored(members.join(several.select("key"), "key"), "open")


def _rays(members: DataFrame, verifier: _Verifier) -> DataFrame:
    """Estimates (hub, id, estimate) of members with the smallest member of each of their buckets."""
    pairs = members.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    return stored(verifier.estimates(pairs, -1.0).withColumnsRenamed({"a": "hub", "b": "id"}), "estimates")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """One row per input row: its id, `n_shingles`, `component_id`, `kept`.

    Words are runs without ASCII white space, A-Z in lower case; shingles are `width` words, fewer words
    are one shingle, sets are compared by 64-bit hashes. Null, empty and blank texts have no shingles and
    are linked with nothing. The component is the smallest id reached by links, and that row is kept.
    Rows that repeat an id count as one document with several texts. Rows without an id are linked
    with nothing, have no component and are kept. Other columns are ignored; an empty table gives an
    empty result.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), empty_for_null(text_col).alias("body"))
    schema = f"id {kind}, n_shingles bigint, mark bigint, mark_2 bigint, registers binary"
    sketches = stored(rows.mapInArrow(_sketch(width), schema), "sketches")
    able = sketches.filter("n_shingles > 0 AND id IS NOT NULL")
    # Documents with equal sets have one representative, so copies meet in no bucket.
    marks = ["n_shingles", "mark", "mark_2"]
    same = stored(able.groupBy(*marks).agg(F.min("id").alias("first")), "classes")
    one = able.join(same.withColumnRenamed("first", "id"), ["id", *marks]).select("id", "n_shingles", "registers")
    one = stored(one, "representatives")

    sizes = _bands(one).groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("hub"))
    shared = stored(sizes.filter("size > 1"), "buckets")
    members = stored(_bands(one).join(shared, "key").select("key", "id", "size", "hub"), "members")
    nodes = stored(members.select(F.col("id").alias("node")).distinct(), "nodes")
    wanted = rows.join(nodes.withColumnRenamed("node", "id"), "id", "left_semi")
    sets = stored(wanted.mapInArrow(_sets(width), f"id {kind}, shingles array<bigint>"), "sets")
    verifier = _Verifier(stored(one.join(nodes.withColumnRenamed("node", "id"), "id", "left_semi"), "candidates"), sets)

    nearest = members.filter("hub < id").groupBy("id").agg(F.min("hub").alias("a"))
    links = verifier.links(nearest.select("a", F.col("id").alias("b")))
    labels = merge_components(nodes.select("node", F.col("node").alias("label")), links)
    open_ = _open(members, labels)
    rays = _rays(open_, verifier)
    # An id with several texts has no difference of its own from a consensus; it stays a cluster by itself.
    texts = one.groupBy("id").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("id")
    alone = rays.join(texts, "id", "left_anti").join(texts.withColumnRenamed("id", "hub"), "hub", "left_anti")
    clusters = _clusters(open_.select(F.col("id").alias("node")).distinct(), alone)
    labels = _within_clusters(clusters, labels, verifier)
    labels = _settled(open_, labels, verifier, small_bucket, rays, clusters)

    classes = able.join(same, marks).select("id", F.col("first").alias("class"))
    classes = classes.join(labels.withColumnsRenamed({"node": "class"}), "class", "left")
    reached = F.coalesce("label", "class")
    of_id = classes.groupBy("id").agg(F.min(reached).alias("component_id"), F.max(reached).alias("other"))
    of_id = stored(of_id, "component-of-id")
    # Rows that repeat an id with other texts join the components of these texts.
    several = of_id.filter("component_id <> other").select(F.col("component_id").alias("a"), F.col("other").alias("b"))
    if not several.isEmpty():
        ends = several.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        joined_up = merge_components(stored(ends.select("node", F.col("node").alias("label")), "ends"), several)
        of_id = of_id.join(joined_up.withColumnRenamed("node", "component_id"), "component_id", "left")
        of_id = of_id.select("id", F.coalesce("label", "component_id").alias("component_id"))
    result = sketches.select("id", "n_shingles").join(of_id.select("id", "component_id"), "id", "left")
    component = F.coalesce("component_id", "id")
    return result.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        (F.col("id").isNull() | (component == F.col("id"))).alias("kept"),
    )
