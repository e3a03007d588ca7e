"""Periodic runs of words: stretches that repeat with one period, by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least REPEATS periods long, that no
neighbour extends. Periods below SHORT are found by direct scans, which compare every word with
the one q places on. Longer periods are cut into scales [a, b). At a scale

- every place has the hash of the k words from there; in each window of w = b - 1 places the
  leftmost least hash marks a place, a minimizer;
- a run with a period of the scale holds two equal windows one period apart, since
  w + k - 1 + q <= 3 q, so their minimizers are one period apart and equal: each pair of equal
  minimizers at a distance of the scale is a seed;
- a seed is extended both ways to the maximal stretch by binary search over prefix hashes, and
  each stretch found is then compared word by word.

Places whose k words have themselves a period of at most k / 3 are no minimizers. These lie in
runs that smaller scales have found already, and a run whose places are all of this kind would
have that smaller period. Equal minimizers are therefore more than k / 3 places apart, a place
has at most about ten partners, and the work is linear in the text at each scale, also for
texts that repeat a single word. No run is missed: hashes only choose the seeds.

The documents of a batch are treated together as one array of word numbers, with a number of
its own after each document, so that nothing equals across.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tapewire.llm.shingles import chunks, mix
from tapewire.llm.store import bound_batches

REPEATS, MIN_LENGTH = 3, 24
# Periods below are scanned directly; a scale's last period is SCALE times its first.
SHORT, SCALE = 12, 1.5
CHUNK = 2 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"

_BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(0x2545F4914F6CDD1D, -1, 1 << 64))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(32)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Words:
    """Word numbers with prefix hashes, so that two stretches compare at once."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.up = _powers(_BASE, len(x) + 1)
        self.down = _powers(_INVERSE, len(x) + 1)
        self.sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(mix(x.astype(np.uint64) + np.uint64(1)) * self.up[:-1], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """A hash of the k words from each place."""
        n = len(self.x) - k + 1
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:n])

    def same(self, a: np.ndarray, b: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """Whether words a to b equal those ``lag`` places on, by their hashes."""
        here = (self.sums[b] - self.sums[a]) * self.up[lag]
        return here == self.sums[b + lag] - self.sums[a + lag]

    def extended(self, p: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the longest stretch around p with period ``lag``."""
        # Words p to p + low are equal to those a lag on, words p to p + high are not.
        low, high = np.zeros_like(p), len(self.x) - lag - p + 1
        while np.any(high - low > 1):
            half = (low + high) // 2
            fits = self.same(p, p + half, lag)
            low, high = np.where(fits, half, low), np.where(fits, high, half)
        back, high = np.zeros_like(p), p + 1
        while np.any(high - back > 1):
            half = (back + high) // 2
            fits = self.same(p - half, p, lag)
            back, high = np.where(fits, half, back), np.where(fits, high, half)
        return p - back, p + low + lag

    def checked(self, found: np.ndarray) -> np.ndarray:
        """The stretches (start, end, period) compared word by word; those that only the hashes
        hold equal are replaced by what the words of that period give."""
        good = np.array(
            [np.array_equal(self.x[s : e - q], self.x[s + q : e]) for s, e, q in found], bool
        )
        wrong = np.unique(found[~good, 2]) if len(found) else []
        return np.concatenate([found[good], *(scanned(self.x, int(q)) for q in wrong)])


def scanned(x: np.ndarray, lag: int) -> np.ndarray:
    """All maximal stretches (start, end, lag) of REPEATS periods or more, by a direct scan."""
    if len(x) <= lag:
        return np.empty((0, 3), np.int64)
    differs = np.flatnonzero(x[:-lag] != x[lag:])
    begin = np.concatenate([[0], differs + 1])
    end = np.append(differs, len(x) - lag)
    long = end - begin >= (REPEATS - 1) * lag
    begin, end = begin[long], end[long] + lag
    return np.stack([begin, end, np.full(len(begin), lag)], axis=1)


def _minima(key: np.ndarray, w: int) -> np.ndarray:
    """The least key of each window of w places."""
    n = len(key)
    blocks = np.full(-(-n // w) * w, _NONE)
    blocks[:n] = key
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[: n - w + 1], behind[w - 1 : n])


def _seeds(words: _Words, a: int, b: int, w: int, k: int, known: np.ndarray):
    """Pairs (place, distance) of equal minimizers at a distance from a to below b."""
    hashes = words.grams(k)
    inside = known[(known[:, 2] <= k // 3) & (known[:, 1] - known[:, 0] >= k)]
    covered = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(covered, inside[:, 0], 1)
    np.add.at(covered, inside[:, 1] - k + 1, -1)
    key = (hashes >> _LOW << _LOW) | np.arange(len(hashes), dtype=np.uint64)
    key[np.cumsum(covered[:-1]) > 0] = _NONE
    least = _minima(key, w)
    least = least[least != _NONE]
    if not len(least):
        return least.astype(np.int64), least.astype(np.int64)
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])]
    order = np.argsort(hashes[place], kind="stable")
    place, value = place[order], hashes[place[order]]
    at, lag = [], []
    for j in range(1, len(place)):
        near = (value[j:] == value[:-j]) & (place[j:] - place[:-j] < b)
        if not near.any():
            break
        seed = np.flatnonzero(near & (place[j:] - place[:-j] >= a))
        at.append(place[seed])
        lag.append(place[seed + j] - place[seed])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *at]), np.concatenate([none, *lag])


def find_runs(x: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs (document, start, length, period), sorted; ``x``: word numbers of all documents,
    ``sizes``: words of each. Starts count from the document's first word."""
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    # A number of its own after each document.
    apart = np.insert(x, np.cumsum(sizes), x.max(initial=0) + 1 + np.arange(len(sizes)))
    found = [scanned(apart, q) for q in range(1, SHORT)]
    runs = np.concatenate(found)
    kept, words, first = sizes >= 0, None, begin
    a = SHORT
    while len(sizes) and REPEATS * a <= sizes.max():
        b = int(a * SCALE)
        w, k = b - 1, 2 * a - b + 2
        long = sizes >= REPEATS * a
        if words is None or long.sum() < kept.sum():
            kept = long  # documents long enough for such a period
            # Where a kept document starts among all, and among the kept ones.
            first = np.cumsum(np.where(kept, sizes + 1, 0)) - np.where(kept, sizes + 1, 0)
            words = _Words(apart[kept[owner]])
        whose = owner[runs[:, 0]]
        shift = (first - begin)[whose]
        known = runs[kept[whose]].copy()
        known[:, :2] += shift[kept[whose]][:, None]
        at, lag = _seeds(words, a, b, w, k, known)
        start, end = words.extended(at, lag)
        enough = end - start >= REPEATS * lag
        new = np.unique(np.stack([start, end, lag], axis=1)[enough], axis=0)
        new = words.checked(new)
        back = (begin - first)[np.flatnonzero(kept)[_which(first[kept], new[:, 0])]]
        new[:, :2] += back[:, None]
        runs = np.concatenate([runs, new])
        a = b
    # Of periods with one stretch, the least divides the others.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh & (runs[:, 1] - runs[:, 0] >= min_length)]
    whose = owner[runs[:, 0]]
    runs = np.stack(
        [whose, runs[:, 0] - begin[whose], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1
    )
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _which(first: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, place, side="right") - 1


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def _found(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        )
        for batch in batches:
            for part in chunks(batch, batch.schema.get_field_index("_text"), CHUNK):
                words = [t.as_buffer().to_pybytes().split() for t in part.column("_text")]
                flat = pa.array([w for text in words for w in text], pa.binary())
                x = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
                sizes = np.array([len(text) for text in words], np.int64)
                runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
                for doc, *run in find_runs(x, sizes, min_length).tolist():
                    runs[doc].append(tuple(run))
                texts = [_collapsed(w, r) for w, r in zip(words, runs, strict=True)]
                named = [
                    [{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs
                ]
                kept = [n for n in part.schema.names if n != "_text"]
                yield pa.record_batch(
                    [
                        *(part.column(n) for n in kept),
                        pa.array(sizes),
                        pa.array(named, kind),
                        pa.array(texts, pa.binary()),
                    ],
                    names=[*kept, "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, *keep: str, min_length: int = MIN_LENGTH) -> DataFrame:
    """Columns ``keep`` with (n_words, runs, collapsed) of the ``text`` of each row.

    Words lie between ASCII white space and compare as bytes. ``runs``: (start, length, period)
    in words, by start and period, of at least ``min_length`` words and three periods.
    ``collapsed``: the words without what runs repeat, joined by one space.

    A null text counts as empty; without words there are no runs and the collapsed text is
    empty. Repeated rows stay; an empty table gives no rows. Kept columns with the name of a
    result are left out; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    added = T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed binary")
    kept = [c for c in keep if c not in added.names]
    rows = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_text"))
    schema = T.StructType(rows.select(*kept).schema.fields + added.fields)
    found = rows.mapInArrow(_found(min_length), schema)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def digest(found: DataFrame) -> DataFrame:
    """One row of numbers and hashes for each row of ``periodic_runs``.

    The run shown has the greatest length over period, compared exactly; of equal ones the one
    that starts first, then the shorter period.
    """

    def better(best, run):
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", nothing, better)
    line = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")
    ))
    shown = found.withColumn("_best", best)
    return shown.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start", "_best.length", "_best.period",
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where every tenth document (by its id's hash) repeats itself from some
    word on.

    Of the n words of such a text, those from word a on become words a, a + 1, ..., a + p - 1 in
    turn. Other texts stay as they are, as do texts without words and those without an id.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    rows = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")
    ).withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def moved(i):
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    places = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    planted = F.array_join(F.transform(places, lambda i: F.get("words", moved(i).cast("int"))), " ")
    text = F.when(F.col("n") > 0, planted).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
