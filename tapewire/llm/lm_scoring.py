"""Log-likelihood of whole texts under a gated recurrent language model, and a unigram base.

1. Texts are read once, in blocks of BLOCK bytes. A block has a dictionary of its own; its texts
   become numbers in it, and it says how often its training texts hold each word.
2. The dictionaries of all blocks meet by word, where counts add up to those of the corpus, and
   each block's dictionary gets back count and rank of its words. So no task ever holds the words
   of the whole corpus. Blocks meet their dictionaries in a grouping by block.
3. The model's tokens are the RANKED most frequent words (the end of a text among them) and, for
   all other words, bands of counts: band j has the words with 2^j to 2^(j+1) - 1 occurrences. A
   word's share within its band is its share of the band's occurrences. The lowest band holds
   the words that occur once, all alike, and any word that training texts lack, which
   counts as one more of these.
4. Training texts are dealt to shards by a hash. In each of ROUNDS a share of them is learned
   from: each shard trains the model from the common parameters on, and the outcomes are averaged,
   weighted by tokens. Every training text is used once, and what shards send grows with the corpus.
5. The model scores every text from its first token to its end.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tapewire.llm.recurrent import Layout, Model, initial, packed, unpacked
from tapewire.llm.store import Scratch, bound_batches

BLOCK = 12 << 20
BLOCKS_A_TASK = 4
RANKED = 1024
# Tokens of a shard, and shards of a task.
SHARD, SHARDS_A_TASK = 4_000_000, 2
# Of SLOTS equal parts of the training texts, the parts of each round, and its learning rate.
SLOTS = 8
ROUNDS = [(range(0, 1), 0.01), (range(1, 3), 0.005), (range(3, 8), 0.003)]
# Tokens that are scored side by side.
SIDE = 2_000_000
END = b""
LEARN = "crc32(cast(doc_id as string)) % 7 != 2"


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Tokens of all texts, an end after each, and where each text's tokens start."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    words = lists.values.slice(
        lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py()
    ).cast(pa.large_binary())
    at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    # White space at either end leaves empty words, of which the last place becomes the end.
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(filled)])[at]
    sizes = np.diff(before)
    order = np.full(int(before[-1]) + len(sizes), -1, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    inside = np.ones(len(order), bool)
    inside[starts[1:] - 1] = False
    order[inside] = np.flatnonzero(filled)
    taken = words.take(pa.array(order, mask=~inside))
    return pc.fill_null(taken, pa.scalar(END, pa.large_binary())), starts


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane, compressed, after their number."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    n = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], n * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind)[:, 0]


def _block(name: int, parts: list[pa.RecordBatch], kept: list[str]) -> pa.RecordBatch:
    """The rows of a block with their tokens in its dictionary, and a last row with this."""
    rows = pa.Table.from_batches(parts).combine_chunks()
    texts = rows.column("_text").combine_chunks()
    words, starts = _tokens(texts)
    held = words.dictionary_encode()
    codes = held.indices.to_numpy().astype(np.uint32)
    learned = np.repeat(rows.column("_learn").to_numpy(), np.diff(starts))
    n = np.bincount(codes[learned], minlength=len(held.dictionary))
    each = [_pack(codes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    empty = [pa.nulls(1, rows.schema.field(c).type) for c in kept]
    columns = [
        pa.concat_arrays([rows.column(c).combine_chunks(), none])
        for c, none in zip(kept, empty, strict=True)
    ]
    blank = [None] * len(each)
    return pa.record_batch(
        [
            *columns,
            pa.array([name] * (len(each) + 1), pa.int64()),
            pa.array([*each, None], pa.binary()),
            pa.array([*blank, held.dictionary.cast(pa.binary()).to_pylist()], pa.list_(pa.binary())),
            pa.array([*blank, n], pa.list_(pa.int64())),
        ],
        names=[*kept, "_block", "_codes", "_words", "_counts"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A name of its own for each block, also across attempts of a task.
    name = lambda: uuid.uuid4().int >> 65
    parts, size = [], 0
    for batch in batches:
        kept = [n for n in batch.schema.names if n != "_text"]
        at = 0
        lengths = pc.binary_length(batch.column("_text")).to_numpy()
        ends = np.cumsum(lengths)
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            room = int(np.searchsorted(ends, done + BLOCK - size, side="right"))
            stop = min(max(room, at + (not parts)), batch.num_rows)
            if stop > at:
                parts.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1] - done)
            if stop < batch.num_rows:
                yield _block(name(), parts, kept)
                parts, size = [], 0
            at = stop
    if parts:
        yield _block(name(), parts, kept)


class Vocabulary:
    """What the model knows of the corpus's words, in bounded space.

    ``words``: the ranked ones with their counts; ``bands``: for each band that has words its
    (number, words, occurrences), the lowest one always. ``tokens``: all training tokens, of
    ``distinct`` kinds.
    """

    def __init__(self, words: list[tuple[bytes, int]], bands: list[tuple[int, int, int]],
                 tokens: int, distinct: int):
        self.words, self.tokens, self.distinct = words, tokens, distinct
        held = {band: (n, total) for band, n, total in bands}
        n, total = held.pop(0, (0, 0))
        self.bands = [(0, n + 1, total)] + [(b, *held[b]) for b in sorted(held)]
        self.layout = Layout(len(words), len(self.bands))
        self.rank = {word: i for i, (word, _) in enumerate(words)}

    def counts(self) -> np.ndarray:
        return np.array([n for _, n in self.words] + [n for *_, n in self.bands], np.float64)

    def end(self) -> int:
        """The token of a text's end."""
        if END in self.rank:
            return self.rank[END]
        return len(self.words) + int(self.place(np.zeros(1, np.int64))[0])

    def place(self, n: np.ndarray) -> np.ndarray:
        """Which of the bands words with these counts belong to."""
        band = np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1
        return np.searchsorted([b for b, *_ in self.bands], band)

    def encode(self, rank: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token, log10 share within the token, log10 base probability) of words with these
        ranks (-1: none) and counts."""
        ranked = rank >= 0
        place = np.where(ranked, 0, self.place(np.where(ranked, 0, n)))
        words = np.array([w for _, w, _ in self.bands], np.float64)
        total = np.maximum([t for *_, t in self.bands], 1).astype(np.float64)
        share = np.where(place == 0, 1 / words[0], np.maximum(n, 1) / total[place])
        token = np.where(ranked, rank, len(self.words) + place)
        base = np.log10((n + 1) / (self.tokens + self.distinct + 1))
        return token, np.where(ranked, 0.0, np.log10(share)), base


def _encoded(vocabulary: Vocabulary, kept: list[str]):
    """Rows of one block in the model's tokens, by its dictionary's counts and ranks."""

    def run(rows: pa.Table, dictionary: pa.Table) -> pa.Table:
        codes, counts, ranks = (dictionary.column(c).to_numpy() for c in ("code", "n", "rank"))
        flat = [_unpack(x.as_py(), np.uint32) for x in rows.column("_codes")]
        sizes = np.array([len(x) for x in flat], np.int64)
        flat = np.concatenate([np.empty(0, np.uint32), *flat])
        size = int(max(codes.max(initial=0), flat.max(initial=0))) + 1
        n, rank = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        n[codes], rank[codes] = counts, ranks
        token, share, base = vocabulary.encode(rank, n)
        begin = np.cumsum(sizes) - sizes
        total = lambda values: np.add.reduceat(values[flat], begin)
        tokens = token[flat].astype(np.uint16)
        return pa.table(
            [
                *(rows.column(c) for c in kept),
                pa.array(sizes),
                pa.array(total((n > 0).astype(np.int64))),
                pa.array(total(base)),
                pa.array(total(share)),
                pa.array([_pack(tokens[a : a + n]) for a, n in zip(begin, sizes, strict=True)],
                         pa.binary()),
            ],
            names=[*kept, "n_tokens", "n_known", "base_score", "_share", "_tokens"],
        )

    return run


def _flat(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all rows, and where each row's start."""
    each = [_unpack(x.as_py(), np.uint16) for b in batches for x in b.column("_tokens")]
    at = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
    return np.concatenate([np.empty(0, np.uint16), *each]).astype(np.int32), at


def _trained(layout: Layout, end: int, params: np.ndarray, rate: float):
    """Parameters (times tokens) after each shard, from ``params`` on."""

    def outcome(texts: list[pa.RecordBatch]) -> pa.RecordBatch:
        tokens, at = _flat(texts)
        first = np.zeros(len(tokens), bool)
        first[at[:-1]] = True
        model = Model(layout, unpacked(params.copy(), layout))
        model.train(tokens, first, end, rate)
        return _weighted(packed(model.params).astype(np.float64) * len(tokens), len(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, texts = None, []
        for batch in batches:
            shards = batch.column("_shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), len(shards)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if texts and shards[a] != shard:
                    yield outcome(texts)
                    texts = []
                shard = shards[a]
                texts.append(batch.slice(a, b - a))
        if texts:
            yield outcome(texts)

    return run


def _weighted(values: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([n], pa.int64()), pa.array([values.astype("<f8").tobytes()], pa.binary())],
        names=["n", "params"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        for count, raw in zip(batch.column("n"), batch.column("params"), strict=True):
            values = np.frombuffer(raw.as_buffer(), "<f8")
            total = values + (0 if total is None else total)
            n += count.as_py()
    if total is not None:
        yield _weighted(total, n)


def _scored(layout: Layout, end: int, params: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(layout, unpacked(params, layout))

        def scored(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = model.scores(*_flat(parts), end) / math.log(10)
            done = 0
            for part in parts:
                share = part.column("_share").to_numpy()
                score = found[done : done + part.num_rows] + share
                done += part.num_rows
                kept = [n for n in part.schema.names if n not in ("_share", "_tokens")]
                yield pa.record_batch(
                    [*(part.column(n) for n in kept), pa.array(score)], names=[*kept, "score"]
                )

        parts, size = [], 0
        for batch in batches:
            parts.append(batch)
            size += batch.column("n_tokens").to_numpy().sum()
            if size >= SIDE:
                yield from scored(parts)
                parts, size = [], 0
        if parts:
            yield from scored(parts)

    return run


def _vocabulary(counts: DataFrame, ranked: int) -> Vocabulary:
    """From (word, total) of each word: reads sums, ``ranked`` rows and one row a band."""
    sums = counts.agg(F.sum("total").alias("tokens"), F.count("*").alias("words")).first()
    words = counts.orderBy(F.desc("total"), "word").limit(ranked).collect()
    words = [(bytes(r["word"]), r["total"]) for r in words]
    known = F.broadcast(_ranks(counts.sparkSession, words))
    others = counts.join(known, "word", "left_anti")
    band = F.floor(F.log2(F.col("total") + F.lit(0.5))).cast("int").alias("band")
    bands = others.groupBy(band).agg(F.count("*").alias("words"), F.sum("total").alias("n"))
    bands = [(r["band"], r["words"], r["n"]) for r in bands.collect()]
    return Vocabulary(words, bands, sums["tokens"] or 0, sums["words"])


def _ranks(spark: SparkSession, words: list[tuple[bytes, int]]) -> DataFrame:
    """(word, rank) of the ranked words: RANKED rows at most."""
    rows = [(bytearray(w), i) for i, (w, _) in enumerate(words)]
    return spark.createDataFrame(rows, "word binary, rank int")


def train(encoded: DataFrame, vocabulary: Vocabulary, scratch: Scratch) -> np.ndarray:
    """The model's parameters, from rows (_learn, _slot, _shard, n_tokens, _tokens)."""
    layout = vocabulary.layout
    params = packed(initial(layout, vocabulary.counts()))
    texts = encoded.where("_learn").select("_slot", "_key", "n_tokens", "_tokens")
    for slots, rate in ROUNDS:
        rows = texts.where(F.col("_slot").isin(list(slots)))
        n = rows.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
        if not n:
            continue
        shards = -(-n // SHARD)
        tasks = -(-shards // SHARDS_A_TASK)
        dealt = rows.select(F.pmod("_key", F.lit(shards)).alias("_shard"), "_key", "_tokens")
        dealt = dealt.repartition(tasks, "_shard").sortWithinPartitions("_shard", "_key", "_tokens")
        kind = "n long, params binary"
        found = dealt.mapInArrow(_trained(layout, vocabulary.end(), params, rate), kind)
        some = found.repartition(math.isqrt(tasks) + 1).mapInArrow(_added, kind)
        row = scratch.save(some.repartition(1).mapInArrow(_added, kind), "parameters").first()
        params = (np.frombuffer(row["params"], "<f8") / row["n"]).astype(np.float32)
    return params


def lm_scores(docs: DataFrame, *keep: str, learn: str = LEARN, ranked: int = RANKED) -> DataFrame:
    """Columns ``keep`` with (held_out, n_tokens, n_known, train_tokens, base_score, score).

    Needs doc_id and text; learns from the rows where ``learn``, a condition on doc_id. Tokens
    are words between ASCII white space, A-Z lowered, and one end a text. Scores are base-10 log
    probabilities of the whole text: ``base_score`` by counts plus one, ``score`` by the model.

    A null text counts as empty and has its end only. A row whose id is null is held out. Without
    any row to learn from, every text is certain and scores 0. Repeated rows stay, count and
    are learned from as often as they come; an empty table gives no rows. Kept columns with the
    name of a result, or with a name that starts with an underscore, are left out.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "lm")
    added = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = [c for c in keep if c not in added and not c.startswith("_")]
    hashed = F.xxhash64("doc_id", "text")
    rows = docs.select(
        *kept,
        F.coalesce(F.expr(learn), F.lit(False)).alias("_learn"),
        F.pmod(hashed, F.lit(SLOTS)).cast("int").alias("_slot"),
        F.shiftright(hashed, 8).alias("_key"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    inner = [*kept, "_learn", "_slot", "_key"]
    fields = rows.select(*inner).schema.fields
    more = "_block long, _codes binary, _words array<binary>, _counts array<long>"
    schema = T.StructType(fields + T.StructType.fromDDL(more).fields)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    blocks = scratch.save(rows.mapInArrow(_blocks, schema), "blocks")

    dictionaries = blocks.where("_codes is null").select("_block", "_words", "_counts")
    entries = dictionaries.select(
        F.col("_block").alias("_of"),
        F.posexplode(F.arrays_zip("_words", "_counts")).alias("code", "entry"),
    ).select("_of", "code", F.col("entry._words").alias("word"), F.col("entry._counts").alias("n"))
    # A frequent word has an entry in every block, a small share of all entries.
    same = Window.partitionBy("word").orderBy("_of")
    entries = entries.withColumns(
        {
            "total": F.sum("n").over(same.rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing)),
            "first": F.row_number().over(same) == 1,
        }
    )
    entries = scratch.save(entries.where("total > 0").drop("n"), "entries")
    vocabulary = _vocabulary(entries.where("first").select("word", "total"), ranked)
    ranks = F.broadcast(_ranks(spark, vocabulary.words))
    answers = entries.join(ranks, "word", "left").select(
        "_of", "code", F.col("total").alias("n"), F.coalesce("rank", F.lit(-1)).alias("rank")
    )
    tasks = -(-dictionaries.count() // BLOCKS_A_TASK) or 1
    answers = answers.repartition(tasks, "_of")
    texts = blocks.where("_codes is not null").select(*inner, "_block", "_codes")
    done = T.StructType.fromDDL(
        "n_tokens long, n_known long, base_score double, _share double, _tokens binary"
    )
    encoded = (
        texts.repartition(tasks, "_block").groupBy("_block")
        .cogroup(answers.groupBy("_of"))
        .applyInArrow(
            _encoded(vocabulary, inner),
            T.StructType([T.StructField(f.name, f.dataType) for f in [*fields, *done.fields]]),
        )
    )
    encoded = scratch.save(encoded, "encoded")
    scratch.drop(blocks, entries)

    params = train(encoded, vocabulary, scratch)
    ready = encoded.select(
        *kept, (~F.col("_learn")).alias("held_out"), "n_tokens", "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "_share", "_tokens",
    )
    out = T.StructType([f for f in ready.schema.fields if f.name not in ("_share", "_tokens")]
                       + [T.StructField("score", T.DoubleType())])
    return ready.mapInArrow(_scored(vocabulary.layout, vocabulary.end(), params), out)
