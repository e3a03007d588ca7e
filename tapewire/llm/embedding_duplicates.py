"""Near-duplicate vectors by sorted projection passes, or by all pairs of a label on request.

Equal vectors of a label form a class, represented by the smallest id. Classes of equal label
and length are compared with each other:

1. In each pass a vector gets a key of concatenated random hashes: the sides of random
   hyperplanes it lies on. All vectors are sorted by pass, label and key, and so near vectors
   come near each other. Its place in the order is its rank.
2. The order is cut into blocks of two windows. A task holds one block and the window after it
   and compares each vector with the ``window`` vectors that follow: in single precision, with a
   margin above its rounding errors, and what comes near the threshold again in double.
3. A block whose vectors still link at the far end of their windows goes on: in rounds, with the
   blocks up to 1, 3, 7, 15, ... places further, while the last of these still link with it. So
   a group of linked vectors may be larger than any window. Each pair of blocks is a task.

A pair that several passes bring together counts in the first comparison only, which the ranks of
both and the rounds of their blocks tell.

Two vectors at cosine c agree in a hash with probability a = 1 - acos(c)/pi: 0.88 at 0.93, 0.92 at
0.97. A label of no more vectors than a window is compared whole, in one pass. For a larger one,
of n vectors, log2(n / window) leading hashes that agree bring a pair into one window, and
there are as many passes as leave a pair at the threshold out with probability ``MISSED``.
The work of a label so grows with n times its passes: 9 at 10 thousand vectors, 20 at 200
thousand, 28 at a million.

All pairs (``exact``) finds every link. The classes of a label are dealt to parts by a hash.
A task holds two parts, or one with itself, or many small labels, and compares them in tiles. Work
grows with the square of a label's classes, and a class is sent to as many tasks as its label
has parts.

Either way a task returns sums for each vector and links that span what it found connected, not
the pairs themselves. Sums are added up; links become components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tapewire.llm.components import components
from tapewire.llm.store import Scratch, bound_batches

WINDOW = 1024
MISSED = 1e-4
BITS = 62
SEED = 11
# Classes of a part, where a label has few; parts of a label, until they are full; components
# of all vectors of a full part; classes of small labels in a task; rows and columns of a tile.
PART, PARTS, PART_VALUES, PACK = 4096, 8, 1 << 22, 512
TILE = 1024, 4096


def _planes(size: int, number: int) -> np.ndarray:
    return np.random.default_rng((SEED, size, number)).standard_normal((size, BITS))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """The values of each list, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Lists of one length, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind)


def _directions(column: pa.Array) -> np.ndarray:
    """Vectors of one length, brought to length 1, as rows."""
    x = _matrix(column, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each vector and each of its ``passes``, with the vector's key in that pass."""
    weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
    planes: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        vectors = _vectors(batch.column("embedding"))
        sizes = np.array([len(v) for v in vectors], dtype=np.int32)
        passes = batch.column("passes").to_numpy()
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            x = np.stack([vectors[i] for i in rows])
            for number in range(passes[rows].max()):
                if (size, number) not in planes:
                    planes[size, number] = _planes(int(size), number)
                more = passes[rows] > number
                taken = pa.array(rows[more])
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(taken), number, np.int32)),
                        batch.column("label").take(taken),
                        pa.array(sizes[rows[more]]),
                        pa.array((x[more] @ planes[size, number] >= 0) @ weights),
                        batch.column("rep").take(taken),
                        batch.column("class").take(taken),
                    ],
                    names=["pass", "label", "size", "key", "rep", "class"],
                )


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that links (a, b) connect each of n indexes to."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _near(
    x: np.ndarray, half: int, least: float, window: int | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of linked rows, tile by tile: of all pairs of the rows before and from
    ``half``, or of all rows if that is 0, but then at most ``window`` apart if given."""
    narrow = x.astype(np.float32)
    margin = (x.shape[1] + 8) * 2.0**-22
    high, wide = TILE
    if window is not None:
        high = min(high, max(window // 4, 1))
    for at in range(0, half or len(x), high):
        end = min(at + high, half or len(x))
        last = len(x) if window is None else min(end + window, len(x))
        for to in range(half or at, last, wide):
            stop = min(to + wide, last)
            near = narrow[at:end] @ narrow[to:stop].T >= least - margin
            count = np.count_nonzero(near)
            if count * 8 > near.size:
                near = x[at:end] @ x[to:stop].T >= least
            i, j = np.nonzero(near)
            i, j = i + at, j + to
            if not half:
                apart = (j > i) if window is None else (j > i) & (j - i <= window)
                i, j = i[apart], j[apart]
            if count * 8 <= near.size:
                sure = np.einsum("ij,ij->i", x[i], x[j]) >= least
                i, j = i[sure], j[sure]
            if len(i):
                yield i, j


def _compare_all(least: float):
    """Of one or two parts of a label, or of whole labels, the rows that ``_compare`` gives."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by(
            [(n, "ascending") for n in ("label", "size", "part", "rep")]
        )
        group = np.stack([table.column(n).to_numpy() for n in ("label", "size")])
        part = table.column("part").to_numpy()
        reps, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        links, root = np.zeros(len(part), np.int64), np.arange(len(part))
        edges = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        for low, high in zip([0, *edges], [*edges, len(part)], strict=True):
            vectors = table.column("embedding").slice(low, high - low).combine_chunks()
            x, n = _directions(vectors), high - low
            # Two parts are compared with each other only.
            half = int(np.searchsorted(part[low:high], part[low], "right")) % n
            own, joined = copies[low:high].astype(float), np.arange(n)
            for i, j in _near(x, half, least):
                links[low:high] += np.bincount(i, own[j], n).astype(np.int64)
                links[low:high] += np.bincount(j, own[i], n).astype(np.int64)
                a, b = joined[i], joined[j]
                apart = a != b
                if apart.any():
                    joined = _roots(a[apart], b[apart], n)[joined]
            root[low:high] = joined + low
        return _sums_and_spans(links, root, reps)

    return run


def _sums_and_spans(links: np.ndarray, root: np.ndarray, reps: np.ndarray) -> pa.Table:
    counted = np.flatnonzero(links)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return pa.table(
        {
            "u": np.concatenate([reps[counted], reps[linked]]),
            "v": np.concatenate([reps[counted], reps[root[linked]]]),
            "n": np.concatenate([links[counted], np.zeros(len(linked), np.int64)]),
        }
    )


class _Block:
    """Rows of a task in the order of their ranks, and what is found among them."""

    def __init__(self, table: pa.Table):
        self.table = table = table.combine_chunks().sort_by("rank")
        self.rank, self.copies = table.column("rank").to_numpy(), table.column("copies").to_numpy()
        group = np.stack([table.column(n).to_numpy() for n in ("pass", "label", "size")])
        edges = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        self.passes = group[0]
        self.groups = list(zip([0, *edges], [*edges, len(self.rank)], strict=True))
        self.links, self.root = np.zeros(len(self.rank), np.int64), np.arange(len(self.rank))

    def directions(self, low: int, high: int) -> np.ndarray:
        rows = self.table.column("embedding").slice(low, high - low).combine_chunks()
        return _directions(rows)

    def per_pass(self, column: str, low: int, high: int) -> np.ndarray:
        """A row for each pass, a column for each vector of one group."""
        rows = self.table.column(column).slice(low, high - low).combine_chunks()
        return np.ascontiguousarray(_matrix(rows, np.int64).T)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.root[i], self.root[j]
        apart = a != b
        if apart.any():
            self.root = _roots(a[apart], b[apart], len(self.root))[self.root]

    def count(self, i: np.ndarray, j: np.ndarray) -> None:
        n = len(self.links)
        self.links += np.bincount(i, self.copies[j].astype(float), n).astype(np.int64)
        self.links += np.bincount(j, self.copies[i].astype(float), n).astype(np.int64)

    def found(self, block: int, goes_on: bool) -> pa.Table:
        """Sums and spans, and a row (block, its first pass, -1) if the block has to go on."""
        out = _sums_and_spans(self.links, self.root, self.table.column("rep").to_numpy())
        if goes_on:
            more = pa.table({"u": [block], "v": [int(self.passes[0])], "n": [-1]}, schema=out.schema)
            out = pa.concat_tables([out, more])
        return out


def _edge(window: int) -> int:
    """The places at the far end of a window; and links there, or further, to go on for: as many
    as a single vector has that links with all of them."""
    return max(window // 8, 1)


def _compare(least: float, window: int, block: int):
    """Of one block and the window after it: (u, v, n), n links of u; links u-v with n = 0 that
    span them; and n = -1 if the block goes on."""

    def run(table: pa.Table) -> pa.Table:
        rows = _Block(table)
        own = rows.rank // block == rows.rank[0] // block
        far = 0
        for low, high in rows.groups:
            ranks = rows.per_pass("ranks", low, high)
            for i, j in _near(rows.directions(low, high), 0, least, window):
                keep = own[i + low]
                i, j = i[keep], j[keep]
                rows.link(i + low, j + low)
                far += np.count_nonzero(j - i > window - _edge(window))
                for before in ranks[: rows.passes[low]]:
                    fresh = np.abs(before[i] - before[j]) > window
                    i, j = i[fresh], j[fresh]
                rows.count(i + low, j + low)
        return rows.found(int(rows.rank[0] // block), far >= _edge(window))

    return run


def _extend(least: float, window: int, block: int):
    """Of a block and one further on, or of a block itself, what ``_compare`` gives, without pairs
    of a window. Says that the block goes on where the other is the last of its round and
    links with it that no other comparison has."""

    def compared(ranks: np.ndarray, reach: np.ndarray, i: np.ndarray, j: np.ndarray):
        """Whether a pass, with blocks that reach so far, has the pairs."""
        first = ranks[i] <= ranks[j]
        places = np.abs(ranks[i] // block - ranks[j] // block)
        return places <= np.where(first, reach[i], reach[j])

    def run(table: pa.Table) -> pa.Table:
        rows = _Block(table)
        home = int(table.column("home")[0].as_py())
        other = int(table.column("other")[0].as_py())
        left, far = rows.rank // block == home, 0
        for low, high in rows.groups:
            # Blocks are compared with each other only.
            half = 0 if home == other else int(left[low:high].sum())
            if home != other and half in (0, high - low):
                continue
            number = rows.passes[low]
            ranks, before, now = (
                rows.per_pass(c, low, high) for c in ("ranks", "before", "now")
            )
            for i, j in _near(rows.directions(low, high), half, least):
                further = ranks[number][j] - ranks[number][i] > window
                i, j = i[further], j[further]
                rows.link(i + low, j + low)
                # Earlier passes of this round first: they have most of a group's pairs.
                for q in range(number):
                    fresh = ~compared(ranks[q], now[q], i, j)
                    i, j = i[fresh], j[fresh]
                for q in range(len(ranks)):
                    fresh = np.abs(ranks[q][i] - ranks[q][j]) > window
                    fresh &= ~compared(ranks[q], before[q], i, j)
                    i, j = i[fresh], j[fresh]
                rows.count(i + low, j + low)
                # The home block's rows come first and reach equally far.
                if other - home == now[number][0]:
                    far += len(i)
        return rows.found(home, far >= _edge(window))

    return run


FOUND = "u long, v long, n long"


def _all_pairs(classes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """(u, v, n) of every pair of classes of equal label and length."""
    rows = classes.withColumn("size", F.size("embedding"))
    n = F.col("n")
    full = F.greatest(F.floor(F.lit(PART_VALUES) / F.col("size")), F.lit(PACK))
    most = F.least(F.greatest(F.ceil(n / PARTS), F.lit(PART)), full)
    sizes = rows.groupBy("label", "size").agg(F.count("*").alias("n"))
    sizes = scratch.save(
        sizes.where("n > 1").select(
            "label", "size", "n", F.ceil(n / most).cast("int").alias("parts")
        ),
        "sizes",
    )
    small = sizes.where("parts = 1").agg(F.sum("n").alias("n")).first()["n"] or 0
    number = F.xxhash64("rep")
    parts = F.col("parts")
    placed = rows.join(sizes, ["label", "size"]).withColumn(
        "part", F.pmod(number, parts).cast("int")
    )
    # Each part meets each, itself included; labels of one part share tasks.
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    many = parts > 1
    dealt = dealt.select(
        F.when(many, F.col("label")).alias("of_label"),
        F.when(many, F.col("size")).alias("of_size"),
        F.when(~many, F.pmod(F.xxhash64("label", "size"), F.lit(small // PACK + 1))).alias("pack"),
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "label", "size", "part", "rep", "copies", "embedding",
    )
    return dealt.groupBy("of_label", "of_size", "pack", "low", "high").applyInArrow(
        _compare_all(threshold), FOUND
    )


def _n_passes(n, threshold: float, window: int, passes: int | None):
    """Passes over a label of ``n`` classes."""
    if passes is None:
        agree = 1 - math.acos(max(min(threshold, 1.0), -1.0)) / math.pi
        within = F.pow(F.lit(agree), F.log2(n / F.lit(window)))
        many = F.ceil(F.lit(math.log(MISSED)) / F.ln(1 - F.least(within, F.lit(1 - 1e-9))))
    else:
        many = F.lit(passes)
    return F.when(n <= window, 1).otherwise(many).cast("int")


def _sorted_passes(
    classes: DataFrame, threshold: float, passes: int | None, window: int, scratch: Scratch
) -> DataFrame:
    """(u, v, n) of the pairs of classes that a pass brings within a window, or within the blocks
    that go on from there."""
    rows = classes.withColumn("size", F.size("embedding"))
    n = F.count("*")
    sizes = rows.groupBy("label", "size").agg(
        _n_passes(n, threshold, window, passes).alias("passes"), n.alias("n")
    )
    sizes = scratch.save(sizes.where("n > 1").drop("n"), "sizes")
    kinds = "pass int, label int, size int, key long, rep long, class long"
    keyed = rows.join(sizes, ["label", "size"]).select(
        "rep", "class", "label", "embedding", "passes"
    )
    # A row's number holds its partition and its place there.
    by = ["pass", "label", "size", "key", "rep", "class"]
    order = keyed.mapInArrow(_keys, kinds).repartitionByRange(*by).sortWithinPartitions(*by)
    order = scratch.save(
        order.select("pass", "class", F.monotonically_increasing_id().alias("number")), "order"
    )
    part, place = F.shiftright("number", 33), F.col("number").bitwiseAND((1 << 33) - 1)
    counts = order.groupBy(part.alias("part")).count()
    start = counts.select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("start")
    )
    ranked = order.select("pass", "class", part.alias("part"), place.alias("place")).join(
        start, "part"
    )
    ranks = scratch.save(
        ranked.groupBy("class").agg(
            F.array_sort(
                F.collect_list(F.struct("pass", (F.col("start") + F.col("place")).alias("rank")))
            ).alias("ranks")
        ).select("class", F.col("ranks.rank").alias("ranks")),
        "ranks",
    )
    scratch.drop(order)
    block = 2 * window
    home = F.floor(F.col("rank") / block)
    placed = rows.join(ranks, "class").select(
        "label", "size", "rep", "copies", "embedding", "ranks",
        F.posexplode("ranks").alias("pass", "rank"),
    )
    # The window after a block's last vector lies in the next block.
    blocks = F.when(
        (F.col("rank") % block < window) & (home > 0), F.array(home, home - 1)
    ).otherwise(F.array(home))
    dealt = placed.withColumn("block", F.explode(blocks))
    found = scratch.save(
        dealt.groupBy("block").applyInArrow(_compare(threshold, window, block), FOUND), "windows"
    )
    # The blocks of the first pass go on to their ends before those of the others, which then have
    # little left to find.
    others = found.where("n = -1 and v > 0").select(F.col("u").alias("home")).distinct()
    going_on = found.where("n = -1 and v = 0").select(F.col("u").alias("home")).distinct()
    everything, reached, held_back = found, None, True
    while True:
        if going_on.isEmpty():
            if not held_back:
                return everything.where("n >= 0")
            going_on, held_back = others, False
            continue
        reached = scratch.save(_reach(reached, going_on), "reached")
        found = scratch.save(
            _tiles(rows, ranks, reached, block).groupBy("home", "other").applyInArrow(
                _extend(threshold, window, block), FOUND
            ),
            "further",
        )
        everything = everything.union(found)
        going_on = found.where("n = -1").select(F.col("u").alias("home")).distinct()


def _reach(reached: DataFrame | None, going_on: DataFrame) -> DataFrame:
    """How many places further a block was compared ``before`` this round, and is ``now``."""
    if reached is None:
        return going_on.select("home", F.lit(-1).alias("before"), F.lit(1).alias("now"))
    on = going_on.withColumn("on", F.lit(True))
    return reached.join(on, "home", "full").select(
        "home",
        F.coalesce("now", F.lit(-1)).alias("before"),
        F.when(F.col("on"), F.coalesce(2 * F.col("now") + 1, F.lit(1)))
        .otherwise(F.col("now"))
        .alias("now"),
    )


def _tiles(rows: DataFrame, ranks: DataFrame, reached: DataFrame, block: int) -> DataFrame:
    """The rows of each block that goes on, and of each it is compared with in this round."""
    pairs = reached.where("now > before").select(
        "home",
        F.explode(
            F.sequence(F.col("home") + F.col("before") + 1, F.col("home") + F.col("now"))
        ).alias("other"),
    )
    # Each pair by either of its blocks; one row where they are the same.
    ends = pairs.select(
        F.explode(F.array_distinct(F.array("home", "other"))).alias("at"), "home", "other"
    )
    each = ranks.select("class", F.posexplode("ranks").alias("pass", "rank")).withColumn(
        "at", F.floor(F.col("rank") / block)
    )
    touched = each.join(ends.select("at").distinct(), "at", "left_semi")
    known = touched.select("class").distinct()
    reach = each.join(known, "class", "left_semi").join(
        reached.withColumnRenamed("home", "at"), "at", "left"
    ).groupBy("class").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "pass", "rank",
                    F.coalesce("before", F.lit(-1)).alias("before"),
                    F.coalesce("now", F.lit(-1)).alias("now"),
                )
            )
        ).alias("of")
    )
    reach = reach.select(
        "class", F.col("of.rank").alias("ranks"), F.col("of.before").alias("before"),
        F.col("of.now").alias("now"),
    )
    return touched.join(ends, "at").join(reach, "class").join(rows, "class").select(
        "home", "other", "pass", "rank", "label", "size", "rep", "copies", "ranks", "before",
        "now", "embedding",
    )


def embedding_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    passes: int | None = None,
    window: int = WINDOW,
    exact: bool = False,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows are linked if their labels are equal, their cosine is at least ``threshold`` and a sorted
    pass brings them together. ``passes``: of labels larger than a window; by default as many as
    their size asks for. ``exact``: compare all pairs of a label instead.
    Rows with a null label, and vectors that are null, empty, zero or hold a null or
    non-finite component, link with nothing; nor do vectors of different length. Rows with
    equal vectors and labels are linked with each other. Each row counts for itself, also
    where rows share an id; such rows have the id's component. A row without an id links with
    nothing, has no component and is kept. Other columns are not read.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "embedding-duplicates")
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("int").alias("label"),
        F.col(vector_column).alias("embedding"),
    )
    sound = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    ) & F.exists("embedding", lambda x: x != 0)
    valid = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & sound)
    classes = scratch.save(
        valid.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    member = scratch.save(
        valid.join(classes.drop("class"), ["label", "embedding"]).select("vec_id", "rep", "copies"), "members"
    )

    if exact:
        pairs = _all_pairs(classes, threshold, scratch)
    else:
        pairs = _sorted_passes(classes, threshold, passes, window, scratch)
    found = scratch.save(pairs, "found")
    sums = found.groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    spans = found.where("n = 0").select("u", "v")
    spans = spans.union(member.select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    nodes = components(spans, scratch).toDF("vec_id", "component")
    totals = member.join(sums, "rep", "left").select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")
    )
    per_id = totals.groupBy("vec_id").agg(F.max("n").alias("n"))
    return (
        rows.select("vec_id")
        .join(per_id, "vec_id", "left")
        .join(nodes, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.col("component").isNull().alias("kept"),
        )
    )
