"""Toxicity by a support vector machine with a subsequence string kernel.

The kernel compares two short strings by the letter quadruples that they share, in order and
with gaps: each place where one occurs, spread over s letters, counts DECAY ** s, for s
up to SPAN. Letters that are left out or put in cost weight, not the match. Strings are
divided by the length that their quadruples would have if none came twice.

Units of comparison are words without the characters that are no letters, so ``id-iot`` is one
unit, and runs of single letters, so ``i d i o t`` is one too. Digits that stand for letters are
read as such. Units come from the labelled texts. Landmarks are units that mark either label;
the kernel against them, times the inverse root of their own kernel matrix (the Nystroem
method), gives each unit a vector, and a linear machine with squared hinge loss separates
them. A sentence of a toxic text need not hold an insult, so the machine is trained as for
multiple instances: units of clean texts are negative; of a toxic text, after the first
round, only its strongest units are positive.

The kernel's quadruples are explicit, so the machine is in the end one weight for each,
and scoring adds up weights over the text. A text's score comes from its number of units that
the machine takes for insults, against the number that clean and toxic texts have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tapewire.llm.shingles import chunks, utf8
from tapewire.llm.store import bound_batches

# Bound of the sample that is learned from: whole texts of each label.
TEXTS = 1500
LANDMARKS = 256
SPAN, DECAY = 6, 0.7
ROUNDS = 4
COST = 4.0
# Deviations from which a unit of toxic texts is a positive example in the first round.
SURE = 4.0
# How much more often toxic texts must have a unit that may be a positive example.
RATIO = 4.0
# Weight of bent units beside the other positive examples.
BENT = 1.0
# Bound of the distinct units that the machine is fitted to, the most frequent ones.
UNITS = 30_000
# Weight of clean texts, which are the more frequent ones, beside toxic ones.
CLEAN_LOSS = 5.0
# Log odds of the toxic label for a text that shows nothing.
PRIOR = -2.0
CHUNK = 1 << 20
# Units that are valued at a time.
PART = 100_000

LETTERS = 32
_KIND = np.zeros(256, np.uint8)  # 0: parts units; 1: the place before a unit
_KIND[97:123] = _KIND[65:91] = np.arange(2, 28)
_KIND[128:192] = 28 + (np.arange(128, 192) & 3)
for _digit, _letter in zip(b"013457", b"oieast", strict=True):
    _KIND[_digit] = _KIND[_letter]
# Lead bytes of other letters and characters inside a word that are none.
_DROPPED = np.zeros(256, dtype=bool)
_DROPPED[192:] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_GAPS = [(a, b, c) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]


def units(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, starts, owner): letter classes of all units, each after a 1; where units
    start; and the text that each belongs to."""
    kind = _KIND[data]
    letter = kind > 0
    # A place before each word: its first letter after a blank or a text's start.
    word = np.cumsum(_BLANK[data])
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    keep = np.flatnonzero(letter)
    if not len(keep):
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    kind, word, text = kind[keep], word[keep], text[keep]
    first = np.ones(len(keep), dtype=bool)
    first[1:] = (word[1:] != word[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(keep)))
    # Single letters go on with a single letter before them.
    single = size == 1
    joined = np.zeros(len(begin), dtype=bool)
    joined[1:] = single[1:] & single[:-1] & (text[begin[1:]] == text[begin[:-1]])
    begin = begin[~joined]
    letters = np.insert(kind, begin, 1)
    return letters, begin + np.arange(len(begin)), text[begin]


def _norm(sizes: np.ndarray) -> np.ndarray:
    """The length of a unit's quadruples if none came twice; ``sizes`` with the place before it."""
    total = np.zeros(len(sizes))
    for *_, c in _GAPS:
        total += np.maximum(sizes - c, 0) * DECAY ** (2 * (c + 1))
    return np.sqrt(np.maximum(total, DECAY**8))


def _codes(letters: np.ndarray) -> Iterator[tuple[np.ndarray, int, float]]:
    """For each pattern of gaps: the code of letters there from each place, span and weight."""
    wide = letters.astype(np.int32)
    for a, b, c in _GAPS:
        n = max(len(wide) - c, 0)
        code = (wide[:n] << 15) | (wide[a : a + n] << 10) | (wide[b : b + n] << 5) | wide[c:]
        yield code, c, DECAY ** (c + 1)


def _runs(letters: np.ndarray, unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Places, codes and weight of the subsequences within units, pattern by pattern."""
    for code, span, weight in _codes(letters):
        within = np.flatnonzero(unit[: len(code)] == unit[span:])
        yield within, code[within], weight


def _sums(letters: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The machine's value for each unit; ``weights``: of all codes."""
    sizes = np.diff(np.append(starts, len(letters)))
    out = np.empty(len(starts))
    # In parts, which bounds what the patterns take beside the letters.
    for low in range(0, len(starts), PART):
        own = slice(low, low + PART)
        first = starts[low]
        held = letters[first : first + sizes[own].sum()]
        unit = np.repeat(np.arange(len(sizes[own]), dtype=np.int32), sizes[own])
        per_place = np.zeros(len(held), np.float32)
        for code, span, weight in _codes(held):
            value = weights[code]
            value *= np.float32(weight)
            value[unit[: len(code)] != unit[span:]] = 0
            per_place[: len(code)] += value
        out[own] = np.add.reduceat(per_place, starts[own] - first) / _norm(sizes[own])
    return out


def _all_units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``units`` of many texts, some at a time."""
    parts, done, held, low = [], 0, 0, 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size < CHUNK):
            size += len(texts[high])
            high += 1
        letters, starts, owner = units(*utf8(pa.array(texts[low:high], pa.string())))
        parts.append((letters, starts + held, owner + low))
        held, low = held + len(letters), high
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


class Machine:
    """Weights of quadruples and what a text's number of hits means.

    ``clean`` and ``toxic``: the share of units above the threshold in texts of either label.
    """

    def __init__(self, weights: np.ndarray, bias: float, clean: float, toxic: float):
        self.weights, self.bias = weights.astype(np.float32), bias
        self.clean, self.toxic = clean, toxic

    def hits(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text its number of units and of those taken for insults."""
        letters, starts, owner = units(data, at)
        n = len(at) - 1
        if not len(starts):
            return np.zeros(n), np.zeros(n)
        found = _sums(letters, starts, self.weights) + self.bias > 0
        return np.bincount(owner, minlength=n), np.bincount(owner, found, n)

    def probability(self, n: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Of the toxic label, by the rates of hits of both labels.

        A toxic text may be less dense than others, so its rate if toxic is taken as what it
        shows, between one and a half times the clean and the toxic rate.
        """
        n = np.maximum(n, 1)
        rate = np.clip(hits / n, min(1.5 * self.clean, self.toxic), self.toxic)
        odds = PRIOR + hits * np.log(rate / self.clean) - n * (rate - self.clean)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.probability(*self.hits(data, at))


def _separate(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of the linear machine with squared hinge loss, by Newton steps.

    The last column of ``x`` is 1, and its weight the bias.
    """
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-3
    for _ in range(20):
        short = 1 - y * (x @ w.astype(x.dtype))
        active = np.flatnonzero(short > 0)
        gradient, hessian = ridge * w, np.diag(ridge)
        for low in range(0, len(active), 8192):
            rows = active[low : low + 8192]
            xa, ca = x[rows].astype(np.float64), cost[rows]
            gradient -= 2 * xa.T @ (ca * y[rows] * short[rows])
            hessian += 2 * (xa * ca[:, None]).T @ xa
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return w


def train(texts: list[str], labels: list[int]) -> Machine | None:
    """A machine from labelled texts; None unless both labels have units."""
    letters, starts, owner = _all_units(texts or [""])
    toxic = np.asarray(labels, dtype=bool)
    if not len(starts) or not toxic[owner].any() or toxic[owner].all():
        return None
    ends = np.append(starts[1:], len(letters))
    words: dict[bytes, int] = {}
    raw = letters.tobytes()
    word = np.fromiter(
        (words.setdefault(raw[a:b], len(words)) for a, b in zip(starts, ends, strict=True)),
        np.int64, len(starts),
    )
    names = list(words)
    # Texts of either label that have the unit.
    pairs = np.stack(np.divmod(np.unique(word * len(texts) + owner), len(texts)))
    in_toxic = np.bincount(pairs[0], toxic[pairs[1]], len(names))
    in_clean = np.bincount(pairs[0], ~toxic[pairs[1]], len(names))
    n_toxic, n_clean = max(toxic.sum(), 1), max((~toxic).sum(), 1)
    # By how many deviations more toxic texts have the unit than its rate in clean ones says.
    expected = (in_clean + 0.5) * n_toxic / n_clean
    lead = (in_toxic - expected) / np.sqrt(expected + 1)
    lead[in_toxic < RATIO * expected] = 0
    half = LANDMARKS // 2
    marked = np.argsort(-lead, kind="stable")[:half]
    common = np.argsort(-in_clean, kind="stable")[:half]
    picked = list(dict.fromkeys([*marked[lead[marked] > SURE], *common]))
    if lead[picked[0]] <= SURE:
        return None

    table = np.zeros(LETTERS**4, np.int32)

    def kernel_rows(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p in parts])
        flat = np.frombuffer(b"".join(parts), np.uint8)
        unit = np.repeat(np.arange(len(parts)), sizes)
        return flat, unit, _norm(sizes)

    flat, unit, norm = kernel_rows([names[i] for i in picked])
    found = list(_runs(flat, unit))
    codes = np.unique(np.concatenate([c for _, c, _ in found]))
    table[codes] = np.arange(1, len(codes) + 1)
    marks = np.zeros((len(codes) + 1, len(picked)))
    for places, code, weight in found:
        np.add.at(marks, (table[code], unit[places]), weight)
    marks /= norm
    own = marks.T @ marks
    values, vectors = np.linalg.eigh(own)
    root = (vectors / np.sqrt(np.maximum(values, 0) + 1e-3)) @ vectors.T
    mapped = (marks @ root).astype(np.float32)

    # Units to learn from: all that several texts have, and the others up to a bound.
    chosen = np.argsort(-(in_toxic + in_clean), kind="stable")[:UNITS]
    def vectors_of(parts: list[bytes]) -> np.ndarray:
        x = np.zeros((len(parts), len(picked)), np.float32)
        for low in range(0, len(parts), 10_000):
            flat, unit, norm = kernel_rows(parts[low : low + 10_000])
            for places, code, weight in _runs(flat, unit):
                rows = table[code]
                known = rows > 0
                np.add.at(x, low + unit[places[known]], weight * mapped[rows[known]])
            x[low : low + 10_000] /= norm[:, None]
        return x

    x = vectors_of([names[i] for i in chosen])
    # Marked units with one letter put in, at each place inside, are positive as well.
    sure = marked[lead[marked] > SURE]
    bent = vectors_of([_bent(names[i], k) for i in sure for k in range(2, len(names[i]))])

    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    positive = np.log1p(in_toxic[chosen]) * (lead[chosen] > SURE)
    negative = np.log1p(in_clean[chosen])
    within = place[pairs[0]] >= 0
    instance, text = place[pairs[0][within]], pairs[1][within]
    examples = np.vstack([x, x, bent])
    examples = np.hstack([examples, np.ones((len(examples), 1), np.float32)])
    y = np.concatenate([np.ones(len(x)), -np.ones(len(x)), np.ones(len(bent))])
    for turn in range(ROUNDS):
        costs = [
            positive / max(positive.sum(), 1e-9),
            negative / max(negative.sum(), 1e-9),
            np.full(len(bent), BENT / max(len(bent), 1)),
        ]
        cost = COST * len(chosen) / 2 * np.concatenate(costs)
        used = cost > 0
        w = _separate(examples[used], y[used], cost[used])
        value = x @ w[:-1] + w[-1]
        if turn + 1 < ROUNDS:
            # Units of clean texts on the wrong side count more from now on.
            negative = negative * np.where(value > 0, 5.0, 1.0)
            # The strongest unit of each toxic text, and all that come near it.
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, text, value[instance])
            witness = toxic[text] & (value[instance] >= np.maximum(best[text] - 0.2, -0.5))
            count = np.bincount(instance[witness], minlength=len(chosen))
            positive = np.log1p(count) * (lead[chosen] > 1)
    weights = np.zeros(LETTERS**4)
    weights[codes] = mapped[1:].astype(np.float64) @ w[:-1]
    # Toxic texts count a second time, with a letter in each marked unit.
    again = np.flatnonzero(toxic[owner])
    inside = np.zeros(len(names), dtype=bool)
    inside[sure] = True
    copied = [
        _bent(names[i], 2 + at % max(len(names[i]) - 2, 1)) if inside[i] else names[i]
        for at, i in zip(again.tolist(), word[again].tolist(), strict=True)
    ]
    sizes = np.array([len(p) for p in copied])
    return _calibrated(
        weights,
        np.concatenate([letters, np.frombuffer(b"".join(copied), np.uint8)]),
        np.concatenate([starts, len(letters) + np.cumsum(sizes) - sizes]),
        np.concatenate([owner, len(toxic) + owner[again]]),
        np.concatenate([toxic, toxic]),
        np.concatenate([np.ones_like(toxic), toxic]),
    )


def _bent(unit: bytes, k: int) -> bytes:
    """The unit with a letter put in before place ``k``."""
    return unit[:k] + bytes([2 + (7 * k + len(unit)) % 26]) + unit[k:]


def _calibrated(
    weights: np.ndarray, letters: np.ndarray, starts: np.ndarray, owner: np.ndarray,
    toxic: np.ndarray, known: np.ndarray,
) -> Machine:
    """The machine whose threshold for a unit tells the labelled texts (``known``) apart best."""
    value = _sums(letters, starts, weights.astype(np.float32))
    n = np.bincount(owner, minlength=len(toxic))
    toxic, clear = toxic & known, ~toxic & known
    top = np.full(len(toxic), -np.inf)
    np.maximum.at(top, owner, value)
    machines, losses = [], []
    for threshold in np.linspace(*np.quantile(top[n > 0], [0.02, 0.98]), 60):
        hits = np.bincount(owner, value > threshold, len(toxic))
        # Rates with one hit added, so that a label without hits has one.
        clean = (hits[clear].sum() + 1) / (n[clear].sum() + 1)
        marked = max((hits[toxic].sum() + 1) / (n[toxic].sum() + 1), 2 * clean)
        machine = Machine(weights, -float(threshold), clean, marked)
        p = np.clip(machine.probability(n, hits), 1e-6, 1 - 1e-6)
        machines.append(machine)
        losses.append(-np.log(p[toxic]).mean() - CLEAN_LOSS * np.log(1 - p[clear]).mean())
    # In the middle of the thresholds that do about as well as the best.
    good = np.flatnonzero(np.array(losses) <= 1.1 * min(losses) + 0.01)
    return machines[int(good[len(good) // 2])]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, texts: int = TEXTS
) -> tuple[list[str], list[int]]:
    """The whole texts of at most ``texts`` documents of each label 0 and 1, picked by a hash.

    The bound keeps what is broadcast to 2 x texts ids, and what the driver holds to 2 x texts
    texts. Texts of rows that share an id count once.
    """
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "toxic", "doc_id", F.xxhash64("doc_id").alias("hash")
    )
    slots = marked.groupBy("toxic", F.pmod("hash", F.lit(texts)).alias("slot"))
    picked = slots.agg(F.min(F.struct("hash", "doc_id")).alias("first"))
    picked = picked.select("toxic", F.col("first.doc_id").alias("doc_id"))
    rows = docs.where(F.length("text") > 0).join(F.broadcast(picked), "doc_id")
    whole = F.struct(F.xxhash64("text"), "text")
    found = rows.groupBy("toxic", "doc_id").agg(F.min(whole).alias("first"))
    found = found.select("toxic", "first.text").orderBy("toxic", "text").collect()
    return [r["text"] for r in found], [r["toxic"] for r in found]


SCORE = "score double, predicted int"


def _score(machine: Machine | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, batch.schema.get_field_index("text"), CHUNK):
                scores = np.zeros(part.num_rows)
                if machine is not None:
                    scores = machine.scores(*utf8(part.column("text")))
                rest = [n for n in part.schema.names if n != "text"]
                yield pa.record_batch(
                    [*(part.column(n) for n in rest), pa.array(scores),
                     pa.array((scores >= 0.5).astype(np.int32))],
                    names=[*rest, "score", "predicted"],
                )

    return run


def score_texts(texts: DataFrame, machine: Machine | None, *keep: str) -> DataFrame:
    """Columns ``keep`` of each row with (score, predicted), from its ``text`` alone.

    Null and empty texts score as texts without a hit; without a machine every score is 0.
    """
    bound_batches(texts.sparkSession)
    rows = texts.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType(rows.select(*keep).schema.fields + T.StructType.fromDDL(SCORE).fields)
    return rows.mapInArrow(_score(machine), schema)


def toxicity(
    docs: DataFrame, labels: DataFrame, learn: str = "crc32(cast(doc_id as string)) % 5 != 0"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; learned from rows where ``learn``.

    Labels other than 0 and 1, labels of no document and documents without one teach nothing.
    A row whose id is null is held out. Repeated rows stay. If the labelled rows lack one of
    the labels, every score is 0.
    """
    held_out = F.coalesce(~F.expr(learn), F.lit(True)).alias("held_out")
    rows = docs.select("doc_id", "text", held_out)
    machine = train(*labelled_sample(docs.where(learn), labels.where(learn)))
    return score_texts(rows, machine, "doc_id", "held_out")
