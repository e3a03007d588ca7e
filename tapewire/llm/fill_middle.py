"""Fill-in-the-middle texts: prefix, middle and suffix of a document, cut between its lines.

The units of a text (lines with their line break) form an indexable skip list. A node of an
express lane stands for FAN nodes of the lane below and carries two widths: how many units
and how many code points lie below it. To find where a unit rank begins, a search walks the top
lane while the accumulated unit width stays within the rank, goes down a lane, and so on; the
accumulated code-point width is then the exact place of the cut. A search takes at most
FAN - 1 steps a lane, whatever the length of the text.

Ranks and forms come from a hash of the seed and the document's id, so a document is cut in
the same way on every run and in every partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tapewire.llm.shingles import chunks
from tapewire.llm.store import bound_batches

FAN = 8
# Markers of the parts, in the order in which psm writes them.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK = 4 << 20
ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"


class SkipList:
    """Units of one text in order. Lane 0 is the units; ``lanes[j]`` holds the
    (unit width, code-point width) of each node of lane j."""

    def __init__(self, sizes: list[int]):
        self.units = len(sizes)
        self.lanes = [[(1, size) for size in sizes]]
        while len(self.lanes[-1]) > FAN:
            below = self.lanes[-1]
            self.lanes.append([
                (sum(u for u, _ in below[i : i + FAN]), sum(c for _, c in below[i : i + FAN]))
                for i in range(0, len(below), FAN)
            ])

    def place(self, rank: int) -> int:
        """Code points before unit ``rank``; of all units if the rank is their number."""
        node = units = chars = 0
        for depth, lane in enumerate(reversed(self.lanes)):
            if depth:
                node *= FAN
            while node < len(lane) and units + lane[node][0] <= rank:
                units += lane[node][0]
                chars += lane[node][1]
                node += 1
        return chars


def lines(text: str) -> list[int]:
    """Code points of each line, its line break included."""
    sizes = [len(line) + 1 for line in text.split("\n")]
    sizes[-1] -= 1
    return sizes if sizes[-1] else sizes[:-1]


def transform(text: str, key: str, rate: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text; ``key`` decides at random."""
    units = SkipList(lines(text))
    n = units.units
    digest = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = units.place(low), units.place(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        output = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return n, "spm", a, b - a, output
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _transformed(seed: int, rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, batch.schema.get_field_index("_text"), CHUNK):
                texts = (t.as_buffer().to_pybytes() for t in part.column("_text"))
                ids = part.column("_id").to_pylist()
                found = [
                    transform(str(raw, "utf-8", "surrogateescape"), f"{seed}:{i}", rate, spm)
                    for raw, i in zip(texts, ids, strict=True)
                ]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                out = [x.encode("utf-8", "surrogateescape") for x in columns[4]]
                kept = [n for n in part.schema.names if n not in ("_text", "_id")]
                yield pa.record_batch(
                    [
                        *(part.column(n) for n in kept),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.int64()),
                        pa.array(out, pa.binary()),
                    ],
                    names=[*kept, "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(
    docs: DataFrame, *keep: str, seed: int = 7, rate: int = 100, spm: int = 50
) -> DataFrame:
    """Columns ``keep`` with (n, form, prefix_chars, middle_chars, output) of each row.

    Needs doc_id and text. ``rate``: of a hundred texts, how many are transformed; ``spm``: of a
    hundred of those, how many have the suffix first. ``n``: lines of the text.

    A null text counts as empty. A text that is empty, holds a marker or is not drawn keeps its
    ``form`` plain: ``output`` is the text, the widths are null. A null id is hashed as the
    empty string. Repeated rows stay and are cut alike; an empty table gives no rows. Kept
    columns with the name of a result are left out; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    added = T.StructType.fromDDL(ADDED.replace("output string", "output binary"))
    kept = [c for c in keep if c not in added.names]
    rows = docs.select(
        *kept,
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    schema = T.StructType(rows.select(*kept).schema.fields + added.fields)
    found = rows.mapInArrow(_transformed(seed, rate, spm), schema)
    return found.withColumn("output", F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text, from an output and its form alone.

    Markers are unambiguous: no transformed text holds one, and none can arise where a marker
    meets text, since ``<`` only begins and ``>`` only ends them.
    """
    first = F.lit(len(PREFIX) + 1)
    body = F.substr(F.col(output), first)
    before, after = F.substring_index(body, SUFFIX, 1), F.substring_index(body, MIDDLE, 1)
    middle = F.substr(body, F.length(after) + first)
    psm = F.concat(before, middle, F.substr(after, F.length(before) + first))
    head = F.substring_index(after, PREFIX, 1)
    spm = F.concat(F.substr(after, F.length(head) + first), middle, head)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(
        F.col(output)
    )


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)."""
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
