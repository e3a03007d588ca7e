"""Benchmark passages in documents, by one Aho-Corasick automaton over the items' windows.

Item texts are normalised to words and cut into windows of ten words (a shorter item is one
window). All windows, each with a space at either end, form one automaton. A document's
words are joined by single spaces and scanned once; every occurrence marks its words. Bytes
keep their places under normalisation, so a marked word also gives its span in the text.

The automaton lies in the memory of every Python worker. Items are few beside documents, but
their number is not bounded: their total size is read first, and items beyond AUTOMATON_BYTES
go to further automata, through which the documents pass one after another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tapewire.llm.store import Scratch, bound_batches

WINDOW = 10
AUTOMATON_BYTES = 4 << 20

_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")
RUNS = "array<struct<first:int,last:int>>"
FOUND = f"n_words long, runs {RUNS}, items array<string>"


def words(text: str | None) -> list[bytes]:
    """Lowered words of ASCII letters, digits and any non-ASCII characters, as UTF-8."""
    return (text or "").encode().translate(_PLAIN).split()


def _windows(text: str | None) -> Iterator[bytes]:
    found = words(text)
    for i in range(max(1, len(found) - WINDOW + 1) if found else 0):
        yield b" " + b" ".join(found[i : i + WINDOW]) + b" "


def _automaton(items: list[tuple[str, str | None]]) -> ahocorasick.Automaton | None:
    """Windows with their number of words and the places in ``items`` they come from."""
    owners: dict[bytes, set[int]] = {}
    for place, (_, text) in enumerate(items):
        for window in _windows(text):
            owners.setdefault(window, set()).add(place)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for window, places in owners.items():
        # One character for each byte, which the automaton takes.
        automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(places)))
    automaton.make_automaton()
    return automaton


_automata: dict[int, ahocorasick.Automaton | None] = {}


def _cached(items: list[tuple[str, str | None]]) -> ahocorasick.Automaton | None:
    """The automaton of these items, built once in a Python worker."""
    key = hash(tuple(items))
    if key not in _automata:
        _automata.clear()
        _automata[key] = _automaton(items)
    return _automata[key]


def _scan_text(
    raw: bytes, automaton: ahocorasick.Automaton | None
) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, runs of hit words (first, last), places of the items found."""
    found = raw.split()
    if not found or automaton is None:
        return len(found), [], set()
    line = (b" " + b" ".join(found) + b" ").decode("latin-1")
    matches = list(automaton.iter(line))
    if not matches:
        return len(found), [], set()
    # The space after each word.
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in found), np.int64, len(found)))
    last = np.searchsorted(ends, [end for end, _ in matches])
    runs: list[tuple[int, int]] = []
    places: set[int] = set()
    spans = sorted(
        (int(i) - n + 1, int(i)) for i, (_, (n, _)) in zip(last, matches, strict=True)
    )
    for first, end in spans:
        if runs and first <= runs[-1][1] + 1:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((first, end))
    for _, (_, owners) in matches:
        places.update(owners)
    return len(found), runs, places


def _scan(items: list[tuple[str, str | None]]):
    """Each row with its words, the hit runs and the ids found by these items added to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _cached(items)
        names = [name for name, _ in items]
        for batch in batches:
            n_words, hits, ids = [], [], []
            for text in batch.column("text"):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                n, runs, places = _scan_text(raw.translate(_PLAIN), automaton)
                n_words.append(n)
                hits.append(runs)
                ids.append(sorted({names[p] for p in places}))
            found = {
                "n_words": pa.array(n_words, pa.int64()),
                "runs": pa.array(
                    [[{"first": a, "last": b} for a, b in runs] for runs in hits],
                    pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
                ),
                "items": pa.array(ids, pa.list_(pa.string())),
            }
            rest = [n for n in batch.schema.names if n not in found]
            yield pa.record_batch(
                [batch.column(n) for n in rest] + list(found.values()), names=rest + list(found)
            )

    return run


def _item_groups(benchmark: DataFrame) -> Iterator[list[tuple[str, str | None]]]:
    """The items (id as text, text), at most about AUTOMATON_BYTES of text at a time."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text"
    )
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    groups = -(-size // AUTOMATON_BYTES) or 1
    group = F.pmod(F.xxhash64("id", "text"), F.lit(groups))
    for k in range(groups):
        rows = items.where(group == k).select("id", "text").collect()
        yield sorted({(r["id"], r["text"]) for r in rows}, key=lambda r: (r[0], r[1] or ""))


def _with(df: DataFrame, columns: str) -> T.StructType:
    """The schema of ``df`` with further columns."""
    return T.StructType(df.schema.fields + T.StructType.fromDDL(columns).fields)


def contamination(docs: DataFrame, benchmark: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` and ``text`` with (n_words, runs, items) of each row.

    ``runs``: hit words as runs (first, last), ``items``: ids of the items with occurring
    windows, sorted as text. Null and empty texts have no words. An item without words has no
    window, one without an id counts as the empty string. Repeated rows stay, repeated items
    count once. Other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "decontamination")
    rows = docs.select(*keep, "text")
    schema = _with(rows, FOUND)
    before = None
    for items in _item_groups(benchmark):
        if before is None:
            before = rows.mapInArrow(_scan(items), schema)
            continue
        # Found so far, written so that one automaton at a time is in memory.
        held = scratch.save(before, "scanned").select(
            *keep, "text", F.col("runs").alias("runs_0"), F.col("items").alias("items_0")
        )
        both = _with(held, FOUND)
        before = held.mapInArrow(_scan(items), both).select(
            *keep, "text", "n_words",
            _merged(F.concat("runs", "runs_0")).alias("runs"),
            F.array_sort(F.array_union("items", "items_0")).alias("items"),
        )
    return before


def _merged(runs):
    """Runs in order, those that meet as one."""
    none = F.array().cast(RUNS)

    def add(done, run):
        end = F.element_at(done, -1)
        joined = F.struct(
            end["first"].alias("first"), F.greatest(end["last"], run["last"]).alias("last")
        )
        meets = (F.size(done) > 0) & (run["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1)
        short = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(meets, F.concat(short, F.array(joined))).otherwise(
            F.concat(done, F.array(run))
        )

    return F.aggregate(F.array_sort(runs), none, add)


def spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where runs of words begin and end in the original text, in characters."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_PLAIN))]
    chars = lambda n: len(raw[:n].decode())
    return [(chars(at[a][0]), chars(at[b][1])) for a, b in runs]


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            [{"start": a, "end": b} for a, b in
             spans(text, [(r["first"], r["last"]) for r in runs])] if runs else []
            for text, runs in zip(
                batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True
            )
        ]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        rest = [n for n in batch.schema.names if n != "runs"]
        yield pa.record_batch(
            [*(batch.column(n) for n in rest), pa.array(found, kind)], names=[*rest, "spans"]
        )


def with_spans(found: DataFrame) -> DataFrame:
    """``runs`` of ``contamination`` replaced by ``spans`` (start, end) in the original text."""
    schema = _with(found.drop("runs"), "spans array<struct<start:int,end:int>>")
    return found.mapInArrow(_span_rows, schema)


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of ``contamination``."""
    n_hit = F.aggregate(
        "runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )
