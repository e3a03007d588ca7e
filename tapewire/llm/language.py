"""Language identification by cross-parsing entropy.

Labelled text of each language becomes a suffix automaton. A text is parsed from left to
right into the longest phrases that occur in a language's labelled text; the fewer phrases it
takes, the nearer the language. Phrases times the bits that name a place in the labelled text,
divided by the length of the text, estimate the cross-entropy; the least one wins.

Before that, ASCII and Latin-1 letters are lowered, and every run of other ASCII characters
becomes one space. All further bytes count as letters. The automaton is used as one table
from state and byte to the next state and the number of phrases that end there, and many
stretches of text are parsed side by side as numpy arrays. A stretch ends after STRETCH
bytes, which costs each language at most one phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tapewire.llm.shingles import chunks, utf8
from tapewire.llm.store import bound_batches

# Bound of the sample that is learned from: pieces a language, and characters a piece.
PIECES, PIECE_CHARS = 96, 400
# Most languages that are learned: a worker holds a table of some 30 MB for each.
LANGUAGES = 32
STRETCH = 512
CHUNK = 2 << 20
UNDETERMINED = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def plain(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowered bytes with one space for each run of non-letters, and where texts start."""
    data = _LOWER[data]
    latin = np.zeros(len(data), dtype=bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    data[latin & (data != 0x97)] += 32
    letter = _LETTER[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    starts = at[:-1][at[:-1] < len(data)]
    keep[starts] = letter[starts]
    data[~letter] = 32
    kept = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], kept[at]


class Automaton:
    """The suffix automaton of byte classes, as a table with restarts."""

    def __init__(self, text: bytes, kinds: np.ndarray, n_kinds: int):
        """``kinds``: the class of each byte, 0 for bytes that no labelled text has."""
        step: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for kind in kinds[np.frombuffer(text, np.uint8)].tolist():
            here, new = last, len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            while here >= 0 and kind not in step[here]:
                step[here][kind] = new
                here = link[here]
            if here >= 0:
                other = step[here][kind]
                if length[other] == length[here] + 1:
                    link[new] = other
                else:
                    copy = len(step)
                    step.append(dict(step[other]))
                    length.append(length[here] + 1)
                    link.append(link[other])
                    while here >= 0 and step[here].get(kind) == other:
                        step[here][kind] = copy
                        here = link[here]
                    link[other] = link[new] = copy
            last = new
        # From the start, a byte that does not occur is a phrase of its own.
        restart = np.full(n_kinds, 1, np.int64)
        for kind, state in step[0].items():
            restart[kind] = state * n_kinds << 2
        # Elsewhere, a byte that does not go on also ends the phrase before it.
        table = np.tile(restart + 1, (len(step), 1))
        table[0] = restart
        at = np.repeat(np.arange(len(step)), [len(s) for s in step])
        kind = np.fromiter((k for s in step for k in s), np.int64, len(at))
        to = np.fromiter((v for s in step for v in s.values()), np.int64, len(at))
        table[at, kind] = to * n_kinds << 2
        self.table = table.astype(np.int32).ravel()
        self.bits = float(np.log2(max(len(text), 2)))


class Model:
    """Automata of all languages, from their labelled pieces."""

    def __init__(self, pieces: dict[str, list[str]]):
        self.languages = sorted(pieces)
        texts = []
        for language in self.languages:
            data, at = plain(*utf8(pa.array(pieces[language], pa.string())))
            parts = [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            # A zero byte, which no plain text has, keeps phrases within a piece.
            texts.append(b"\0".join(parts))
        used = np.unique(np.frombuffer(b"".join(texts) + b"\0", np.uint8))
        self.kinds = np.zeros(256, np.uint8)
        self.kinds[used] = np.arange(1, len(used) + 1)
        self.automata = [Automaton(t, self.kinds, len(used) + 1) for t in texts]

    def rates(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits per byte of each text (row) in each language (column)."""
        kinds = self.kinds[data]
        sizes = np.diff(at)
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = at[owner] + nth * STRETCH
        lengths = np.minimum(STRETCH, at[owner + 1] - starts)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths, owner = starts[order], lengths[order], owner[order]
        longest = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")
        n = len(self.automata)
        state = np.zeros((n, len(starts)), np.int32)
        phrases = np.zeros((n, len(starts)), np.int32)
        for t in range(longest):
            k = active[t]
            kind = kinds[starts[:k] + t].astype(np.int32)
            for i, automaton in enumerate(self.automata):
                to = automaton.table[state[i, :k] + kind]
                phrases[i, :k] += to & 3
                state[i, :k] = to >> 2
        phrases += state > 0
        totals = np.stack([np.bincount(owner, p, len(sizes)) for p in phrases], axis=1)
        bits = np.array([a.bits for a in self.automata])
        return totals * bits / np.maximum(sizes, 1)[:, None]


_models: dict[int, Model] = {}


def _model(pieces: dict[str, list[str]]) -> Model:
    """The model of these pieces, built once in a Python worker."""
    key = hash(tuple((k, tuple(v)) for k, v in sorted(pieces.items())))
    if key not in _models:
        _models.clear()
        _models[key] = Model(pieces)
    return _models[key]


def _predict(pieces: dict[str, list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(pieces)
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            for part in chunks(batch, batch.schema.get_field_index("_text"), CHUNK):
                found = np.full(part.num_rows, len(names) - 1)
                score = np.zeros(part.num_rows)
                if model.languages:
                    rates = model.rates(*plain(*utf8(part.column("_text"))))
                    letters = part.column("_letters").to_numpy(zero_copy_only=False)
                    best = np.where(letters, rates.argmin(axis=1), len(names) - 1)
                    ranked = np.sort(rates, axis=1)
                    second = ranked[:, 1] if rates.shape[1] > 1 else np.full(len(rates), np.inf)
                    margin = 1 - ranked[:, 0] / np.maximum(second, 1e-9)
                    found, score = best, np.where(letters, np.clip(margin, 0, 1), 0.0)
                columns = [c for n, c in zip(part.schema.names, part.columns, strict=True)
                           if n not in ("_text", "_letters")]
                yield pa.record_batch(
                    [*columns, pa.array(names[found], pa.string()), pa.array(score)],
                    names=[*(n for n in part.schema.names if n not in ("_text", "_letters")),
                           "lang_pred", "score"],
                )

    return run


def sample_pieces(
    labelled: DataFrame,
    pieces: int = PIECES,
    piece_chars: int = PIECE_CHARS,
    languages: int = LANGUAGES,
) -> dict[str, list[str]]:
    """At most ``pieces`` pieces of texts (lang, text) of each language, picked by a hash.

    A piece starts at a hashed place anywhere in its text, so that heads which a source
    repeats do not fill the sample. The bound keeps what the driver holds to pieces x
    piece_chars characters a language; more than ``languages`` of them are an error.
    """
    room = F.greatest(F.length("text") - piece_chars, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("text", F.lit("place")), room) + 1).cast("int")
    texts = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang",
        F.xxhash64("text").alias("hash"),
        F.substr("text", start, F.lit(piece_chars)).alias("piece"),
    )
    picked = texts.groupBy("lang", F.pmod("hash", F.lit(pieces)).alias("slot")).agg(
        F.min(F.struct("hash", "piece")).alias("first")
    )
    names = [r["lang"] for r in texts.select("lang").distinct().limit(languages + 1).collect()]
    if len(names) > languages:
        raise ValueError(f"more than {languages} languages, as {', '.join(sorted(names)[:5])}")
    out: dict[str, list[str]] = {}
    for row in picked.select("lang", "slot", "first.piece").orderBy("lang", "slot").collect():
        out.setdefault(row["lang"], []).append(row["piece"])
    return out


def identify(texts: DataFrame, pieces: dict[str, list[str]], *keep: str) -> DataFrame:
    """Columns ``keep`` of each row with (lang_pred, score), from its ``text`` alone.

    A text that is null or has no letter is ``und`` with score 0. The score is the share of
    bits that the best language saves against the second best, 1 if there is only one. Equal
    languages go by name. Without any labelled text everything is ``und``. Repeated rows stay.
    """
    bound_batches(texts.sparkSession)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters")
    rows = texts.select(*keep, F.coalesce("text", F.lit("")).alias("_text"), letters)
    found = T.StructType.fromDDL("lang_pred string, score double")
    schema = T.StructType(rows.select(*keep).schema.fields + found.fields)
    return rows.mapInArrow(_predict(pieces), schema)


# Documents that languages are learned from.
LEARN = "crc32(cast(doc_id as string)) % 3 != 1"


def learned_pieces(docs: DataFrame, learn: str = LEARN) -> dict[str, list[str]]:
    """The labelled sample of those documents (doc_id, text, lang) where ``learn``."""
    return sample_pieces(docs.where(learn).select("lang", "text"))


def language_id(docs: DataFrame, learn: str = LEARN) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row; learned from rows where ``learn``.

    A row whose id is null is held out.
    """
    held_out = F.coalesce(~F.expr(learn), F.lit(True)).alias("held_out")
    rows = docs.select("doc_id", "text", held_out)
    return identify(rows, learned_pieces(docs, learn), "doc_id", "held_out")
