"""Token ids of documents in ORC files, ordered by document id.

A file's rows are documents: id, the file's number, the number of ids before the document in
the file, its number of ids, and the ids themselves with the end id. ORC stores integers run
length encoded, keeps minima and maxima for each stripe and for every INDEX_ROWS rows, and
a Bloom filter on the document id. So a reader splits files by stripe, and a search for a few
documents reads the stripes and row groups that may hold them.

Documents are dealt to files by ranges of their id, so files hold disjoint ranges in ascending
order. Where a document starts among the ids of all files follows from the sums of the files.

Texts are cut into pieces where the tokenizer's own splitting cuts whatever stands around,
and each distinct piece is encoded once while it is remembered. That gives the ids of the
whole texts.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapewire.llm.shingles import BYTE_VALUES, chunks, hash_spans, utf8
from tapewire.llm.store import bound_batches

END_ID = 0
CHUNK = 1 << 20
# Pieces that a Python worker remembers before it starts anew.
REMEMBERED = 400_000
INDEX_ROWS = 1000

FILE_ROW = "doc_id long, file int, before long, n_tokens int, ids array<int>"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[10, 32]] = True
# Visible ASCII characters; letters; marks that a word never goes on with.
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[33:127] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?*%&$#")] = True


def _cuts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pieces start: at texts, and at places that the tokenizer always cuts.

    These are a space or line feed after a visible character, what follows a line feed that
    stands alone, and a mark after a letter. Visible characters and letters are ASCII or of
    the Latin-1 block, so the cuts that it makes elsewhere lie within pieces.
    """
    n = len(data)
    latin = np.zeros(n, dtype=bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80)
    visible = _VISIBLE[data] | latin
    letter = _LETTER[data] | (latin & (data != 0x97) & (data != 0xB7))
    begins = np.zeros(n, dtype=bool)
    begins[at[:-1][at[:-1] < n]] = True
    alone = np.zeros(n, dtype=bool)
    alone[1:] = (data[1:] == 10) & visible[:-1]
    cut = begins.copy()
    cut[1:] |= _SPACE[data[1:]] & visible[:-1]
    cut[1:] |= _MARK[data[1:]] & letter[:-1]
    # Lead bytes of Latin-1 letters start a character as well.
    cut[1:] |= alone[:-1] & (_VISIBLE[data[1:]] | (data[1:] == 0xC3))
    # What follows a text's end is another text.
    return np.flatnonzero(cut)


# A piece of letters alone, with a space at most before them, which is one word to the tokenizer.
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is
    printed, else the next one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printed]
    return {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of texts. Of a byte-level vocabulary it remembers pieces, by their hashes.

    ``named``: a token's name inside a text is that token, as the tokenizer has it by itself;
    else it is text.
    """

    def __init__(self, path: str, named: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not named
        splitter = self.tokenizer.pre_tokenizer
        # The cuts hold for this splitting only.
        self.by_piece = (
            isinstance(splitter, pre_tokenizers.ByteLevel)
            and splitter.use_regex
            and not splitter.add_prefix_space
            and self.tokenizer.normalizer is None
            and not (named and self._names_are_cut())
        )
        self.letters = _byte_letters()
        self._forget()

    def _names_are_cut(self) -> bool:
        """Whether a piece could end within a token's name, or the token takes in blanks or
        depends on what stands beside it."""
        for token in self.tokenizer.get_added_tokens_decoder().values():
            cuts = _cuts(*utf8(pa.array([token.content], pa.string())))
            if len(cuts) > 1 or token.lstrip or token.rstrip or token.single_word:
                return True
        return False

    def _ids(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def _piece_ids(self, pieces: list[str]) -> list[list[int]]:
        """Words go to the tokenizer's model, which they reach whole in any case."""
        model = self.tokenizer.model.tokenize
        out = [
            [t.id for t in model(self._letters_of(x))] if _WORD.fullmatch(x) else None
            for x in pieces
        ]
        rest = iter(self._ids([x for x, ids in zip(pieces, out, strict=True) if ids is None]))
        return [next(rest) if ids is None else ids for ids in out]

    def _letters_of(self, word: str) -> str:
        """A word's bytes as characters of the vocabulary; ASCII letters are themselves."""
        if word.isascii():
            return word.replace(" ", self.letters[32])
        return word.encode().decode("latin-1").translate(self.letters)

    def _forget(self) -> None:
        # Sorted hashes of pieces, which entry each has, and where the ids of entries start.
        self.hashes = np.empty(0, np.uint64)
        self.entries = np.empty(0, np.int32)
        self.ids = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Remember further pieces, of sorted hashes."""
        ids = self._piece_ids(pieces)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter(chain.from_iterable(ids), np.int32, sizes.sum())
        entries = np.arange(len(ids), dtype=np.int32) + np.int32(len(self.starts) - 1)
        self.ids = np.concatenate([self.ids, new])
        self.starts = np.concatenate([self.starts, np.cumsum(sizes) + self.starts[-1]])
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.entries = np.concatenate([self.entries, entries])[order]

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is or would be, and whether it is there."""
        at = np.searchsorted(self.hashes, hashes)
        there = at < len(self.hashes)
        there[there] = self.hashes[at[there]] == hashes[there]
        return at, there

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, each with the end id, and their numbers of ids."""
        if not self.by_piece:
            ids = [x + [end_id] for x in self._ids(column.fill_null("").to_pylist())]
            sizes = np.array([len(x) for x in ids], np.int64)
            return np.fromiter(chain.from_iterable(ids), np.int32), sizes
        data, at = utf8(column)
        begin = _cuts(data, at)
        end = np.append(begin[1:], len(data))
        hashes = hash_spans(data, begin, end, BYTE_VALUES)
        distinct, first, code = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self._forget()
        unknown = np.flatnonzero(~self._known(distinct)[1])
        if len(unknown):
            raw, spans = data.tobytes(), first[unknown]
            pieces = [
                raw[a:b].decode() for a, b in zip(begin[spans], end[spans], strict=True)
            ]
            self._learn(distinct[unknown], pieces)
        place = self.entries[self._known(distinct)[0]]
        low = self.starts[place][code]
        size = self.starts[place + 1][code] - low
        # Pieces of a text come in order; the end id follows the last.
        text = np.searchsorted(at, begin, side="right") - 1
        n_tokens = np.bincount(text, size, len(column)).astype(np.int64) + 1
        ends = np.cumsum(n_tokens)
        out = np.full(ends[-1] if len(ends) else 0, end_id, np.int32)
        to = np.cumsum(size) - size + text
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(to, size) + step] = self.ids[np.repeat(low, size) + step]
        return out, n_tokens


_encoders: dict[tuple[str, bool], Encoder] = {}


def _encode(path: str, end_id: int, named: bool):
    """Rows of a file, in the order of the rows that come in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, named) not in _encoders:
            _encoders[path, named] = Encoder(path, named)
        encoder, file, before = _encoders[path, named], TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in chunks(batch, 1, CHUNK):
                ids, sizes = encoder.encode(part.column(1), end_id)
                ends = np.cumsum(sizes)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array(np.full(len(sizes), file, np.int32)),
                        pa.array(before + ends - sizes),
                        pa.array(sizes.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                    ],
                    names=["doc_id", "file", "before", "n_tokens", "ids"],
                )
                before += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, named: bool = False
) -> None:
    """Encode (doc_id, text) with the tokenizer file into ORC files at ``path``.

    ``named``: names of tokens inside a text are these tokens, else they are text.

    A null text counts as empty and has the end id only. Rows that share an id are documents
    of their own, ordered by a hash of their texts; a null id comes first. Other columns are
    not read. An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("tie"),
    )
    order = ["doc_id", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    (
        rows.mapInArrow(_encode(tokenizer, end_id, named), FILE_ROW)
        .write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files: doc_id, file, before, n_tokens, ids."""
    return spark.read.schema(FILE_ROW).orc(path)


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of the documents with these ids, without those that are not there.

    The ids reach the reader: stripes and row groups whose range or Bloom filter excludes all
    of them are not read.
    """
    return read_tokens(spark, path).where(F.col("doc_id").isin(ids))


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, file, before, n_tokens, ids_crc32) from the ids read."""
    for batch in batches:
        ids = batch.column(3)
        values = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        sizes = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)]) * 4
        held = memoryview(values)
        sums = [zlib.crc32(held[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.record_batch(
            [*batch.columns[:3], pa.array(sizes), pa.array(sums, pa.int64())],
            names=["doc_id", "file", "before", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in the files at ``path``.

    ``start``: ids of all documents before it. ``ids_crc32``: of its ids as little-endian
    unsigned 32-bit integers, the end id included.
    """
    bound_batches(spark)
    rows = read_tokens(spark, path)
    # One row for each file: all files before it.
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    starts = sizes.select(
        "file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("first")
    )
    kinds = "doc_id long, file int, before long, n_tokens long, ids_crc32 long"
    checked = rows.select("doc_id", "file", "before", "ids").mapInArrow(_check, kinds)
    return checked.join(starts, "file").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
