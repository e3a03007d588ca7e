"""Near-duplicate texts: MinHash banding, signature verification, exact check, components.

1. One pass over the texts gives each its number of shingles, a digest of its set, 640
   universal hash minima and a key for each of 32 bands of 4 minima. Texts with equal sets
   form a class, represented by the smallest id, and are not compared with each other.
2. Classes that share a band key are candidates. Every member of a bucket is compared with
   the smallest one: first the minima, then the full sets of those that may reach the
   threshold. The links found give components.
3. Buckets whose members still lie in several components are compared further, all members
   of different components with each other, in blocks of bounded size. A pair is taken up
   in the first band that it shares, again by its minima and then by its full sets.

So a bucket of n copies costs n comparisons and n rows, and only a bucket of texts that
share a band but are no copies costs all its pairs, of which those are passed on that may
reach the threshold. No bucket is capped. At a similarity of 0.75 a pair shares no band with
probability 1e-5 and fails the check of its minima with less than 1e-4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapewire.llm.components import components
from tapewire.llm.shingles import MinHash, chunks, sets
from tapewire.llm.store import Scratch, bound_batches

BANDS, ROWS = 32, 4
# Minima that serve the verification only; the bands use the first BANDS * ROWS.
HASHES = 640
SEED = 7
# Four standard deviations of the share of equal minima below the threshold.
SLACK = 4 * (0.75 * 0.25 / HASHES) ** 0.5
BLOCK = 512
# Bytes of text that are hashed at once.
CHUNK = 1 << 20
# Ids of texts to fetch are broadcast up to this number (8 bytes each), else joined by shuffle.
BROADCAST_IDS = 1_000_000

_FUNCTIONS = MinHash(1, HASHES, SEED)
_BANDED = MinHash(BANDS, ROWS, SEED)
SKETCH = "doc_id long, n_shingles long, digest binary, minima binary, keys binary"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, 1, CHUNK):
            found = list(sets(part.column(1)))
            sizes = [len(s) for s in found]
            full = [s for s in found if len(s)]
            starts = np.concatenate([[0], np.cumsum([len(s) for s in full], dtype=np.int64)])
            n = len(full)
            minima = np.empty((0, HASHES), np.uint32)
            if n:
                minima = _FUNCTIONS.signatures(np.concatenate(full), starts)
            keys = _BANDED.keys(minima[:, : BANDS * ROWS])
            low = minima.astype(np.uint8)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in full]
            rows = iter(range(n))
            index = [next(rows) if size else None for size in sizes]

            def column(values: list, index: list = index) -> pa.Array:
                return pa.array([None if i is None else values[i] for i in index], pa.binary())

            yield pa.record_batch(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    column(digests),
                    column([row.tobytes() for row in low]),
                    column([row.tobytes() for row in keys]),
                ],
                names=["doc_id", "n_shingles", "digest", "minima", "keys"],
            )


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    if not len(column):
        return np.empty((0, 1), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _explode_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _matrix(batch.column(1), np.int64)
        for at in range(0, len(keys), 4096):
            part = keys[at : at + 4096]
            ids = np.repeat(batch.column(0).to_numpy()[at : at + 4096], part.shape[1])
            bands = np.tile(np.arange(part.shape[1], dtype=np.int8), len(part))
            columns = [pa.array(part.ravel()), pa.array(bands), pa.array(ids)]
            yield pa.record_batch(columns, names=["key", "band", "rep"])


def _alike(least: float):
    """Pairs whose minima agree in a share of at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_matrix(batch.column(n), np.uint8) for n in ("sig_a", "sig_b"))
            mask = pa.array((a == b).mean(axis=1) >= least if len(a) else [], pa.bool_())
            yield pa.record_batch(
                [batch.column(n).filter(mask) for n in ("a", "b")], names=["a", "b"]
            )

    return run


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, 1, CHUNK):
            found = [s.tobytes() for s in sets(part.column(1))]
            yield pa.record_batch(
                [part.column(0), pa.array(found, pa.large_binary())], names=["id", "set"]
            )


def _linked(percent: int):
    """Pairs with 100 * intersection >= percent * union, on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(n) for n in ("set_a", "set_b"))
            for x, y in zip(*columns, strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch(
                [batch.column(n).filter(mask) for n in ("a", "b")], names=["u", "v"]
            )

    return run


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Those of the saved ``pairs`` (a, b) that are links, as saved (u, v)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids = scratch.save(ids, "ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.join(side, "doc_id", "left_semi")
    held = scratch.save(texts.mapInArrow(_sets_of, "id long, set binary"), "sets")
    b = held.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    a = held.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b")
    links = scratch.save(both.mapInArrow(_linked(percent), "u long, v long"), "links")
    scratch.drop(ids, held)
    return links


def _block_pairs(least: float):
    """Pairs between two blocks of one bucket (or within one) that their minima let pass.

    A pair counts in the first band that both share, and if its components differ.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        reps = table.column("rep").to_numpy()
        comps = table.column("component").to_numpy()
        band = table.column("band")[0].as_py()
        same = table.column("left")[0].as_py() == table.column("right")[0].as_py()
        minima = _matrix(table.column("minima"), np.uint8)
        keys = _matrix(table.column("keys"), np.int64)
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        out_a, out_b = [], []
        need = int(np.ceil(least * minima.shape[1]))
        for i in left:
            others = right[comps[right] != comps[i]]
            if same:
                others = others[reps[others] > reps[i]]
            if not len(others):
                continue
            others = others[(minima[others] == minima[i]).sum(axis=1) >= need]
            others = others[~(keys[others, :band] == keys[i, :band]).any(axis=1)]
            out_a.append(np.full(len(others), reps[i]))
            out_b.append(reps[others])
        none = np.empty(0, np.int64)
        a, b = np.concatenate([none, *out_a]), np.concatenate([none, *out_b])
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _rest(
    rows: DataFrame, found: DataFrame, reps: DataFrame, least: float, scratch: Scratch
) -> DataFrame:
    """Candidate pairs (a, b) of buckets whose members lie in more than one component."""
    labelled = rows.join(
        found.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).select("key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    # The smallest member has been compared with all others.
    open_buckets = (
        labelled.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("rep").alias("center"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("n > 2 and low != high")
        .select("key", "center", F.ceil((F.col("n") - 1) / BLOCK).cast("int").alias("blocks"))
    )
    members = labelled.join(open_buckets, "key").where("rep != center")
    members = scratch.save(members.drop("center"), "members")
    # A member goes to every pair of blocks that has its own.
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.select("*", own.alias("own")).select("*", other.alias("other")).select(
        "key", "band", "rep", "component",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    pairs = (
        dealt.join(reps, "rep")
        .groupBy("key", "left", "right")
        .applyInArrow(_block_pairs(least), "a long, b long")
    )
    pairs = scratch.save(pairs.distinct(), "pairs")
    scratch.drop(members)
    return pairs


def near_duplicates(
    docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Rows are linked if their sets of five-word shingles share at least ``percent`` of their
    union. ``component_id`` is the smallest id that links reach. Null, empty and blank texts
    have no shingles and link with nothing. Rows that share an id are one document, with the
    links of each. A row without an id links with nothing, has no component and is kept.
    Other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "near-duplicates")
    least = percent / 100 - SLACK
    docs = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    sketch = scratch.save(docs.mapInArrow(_sketch, SKETCH), "sketch")
    named = sketch.where("digest is not null and doc_id is not null")
    classes = named.groupBy("digest").agg(
        F.min(F.struct("doc_id", "minima", "keys")).alias("first"), F.count("*").alias("n")
    )
    classes = scratch.save(classes.select("digest", "first.*", "n"), "classes")
    reps = classes.select(F.col("doc_id").alias("rep"), "minima", "keys")
    copies = classes.where("n > 1").select("digest", F.col("doc_id").alias("v"))
    same = named.select("digest", F.col("doc_id").alias("u")).join(copies, "digest")
    same = scratch.save(same.where("u != v").select("u", "v"), "same")

    rows = reps.select("rep", "keys").mapInArrow(
        _explode_keys, "key long, band byte, rep long"
    )
    shared = rows.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("n"))
    buckets = rows.join(shared.where("n > 1").select("key", "center"), "key")
    buckets = scratch.save(buckets, "buckets")
    stars = buckets.where("rep != center").select(
        F.col("center").alias("a"), F.col("rep").alias("b")
    )
    minima = reps.select(F.col("rep").alias("b"), F.col("minima").alias("sig_b"))
    both = stars.distinct().join(minima, "b").join(
        minima.toDF("a", "sig_a"), "a"
    )
    pairs = scratch.save(both.mapInArrow(_alike(least), "a long, b long"), "stars")
    links = _confirm(pairs, docs, percent, scratch)
    found = components(links, scratch)

    pairs_left = _rest(buckets.drop("center"), found, reps, least, scratch)
    more = _confirm(pairs_left, docs, percent, scratch)
    scratch.drop(buckets, classes, pairs, pairs_left)
    if more.isEmpty() and same.isEmpty():
        nodes = found
    else:
        nodes = components(
            found.toDF("u", "v").union(more).union(same), scratch
        )
    return (
        sketch.select("doc_id", "n_shingles")
        .join(nodes.toDF("doc_id", "component"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.col("component").isNull().alias("kept"),
        )
    )
