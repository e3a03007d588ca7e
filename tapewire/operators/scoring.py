"""Sentiment scorers and the columns derived from them.

A scorer maps a text column to ``struct<label string, confidence double>``. Which scorer
to use is a parameter of every operator that needs one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from tapewire.constants import (
    FINANCE_NEGATIVE,
    FINANCE_POSITIVE,
    IMPACT_MODEL_CHARS,
    VOTE_MODEL_CHARS,
)
from tapewire.functions import labels, text
from tapewire.functions.ids import text_key

# Texts from which a task judges by its failures that the model is broken.
FAILURES_FROM = 20

Scorer = Callable[[Column], Column]
Model = Callable[[list[str]], Sequence[tuple[str, float]]]


@dataclass(frozen=True)
class LexiconScorer:
    """Counts listed words over the whole text, row by row inside the JVM.

    The label is the sign of positives minus negatives, the confidence their difference
    over their sum. Words are runs of the letters a to z. Spark turns lists of more than ten
    words into hash sets, so their length does not matter, and nothing is joined or shuffled.
    """

    positive: tuple[str, ...] = tuple(FINANCE_POSITIVE)
    negative: tuple[str, ...] = tuple(FINANCE_NEGATIVE)
    max_chars: int | None = None

    expensive = False

    def __post_init__(self) -> None:
        both = set(self.positive) & set(self.negative)
        if both:
            raise ValueError(f"words listed as positive and as negative: {sorted(both)}")

    def __call__(self, content: Column) -> Column:
        plus, listed = list(self.positive), [*self.positive, *self.negative]
        words = F.split(F.lower(text.clip(content, self.max_chars)), "[^a-z]++")
        hits = F.filter(words, lambda w: w.isin(listed))
        counts = _bind(
            hits,
            lambda h: F.struct(
                F.size(h).alias("all"), F.size(F.filter(h, lambda w: w.isin(plus))).alias("plus")
            ),
        )
        return _bind(counts, lambda c: _verdict(c["plus"], c["all"] - c["plus"]))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def _verdict(plus: Column, minus: Column) -> Column:
    label = F.when(plus > minus, "positive").when(plus < minus, "negative").otherwise("neutral")
    share = F.try_divide(F.abs(plus - minus).cast("double"), plus + minus)
    return F.struct(label.alias("label"), F.coalesce(share, F.lit(0.0)).alias("confidence"))


@functools.lru_cache(maxsize=2)
def _loaded(load: Callable[..., Model], device: str | None) -> Model:
    """One model per Python worker process, kept across tasks."""
    return load() if device is None else load(device)


def task_device() -> str:
    """The GPU that Spark gave to the running task as ``cuda:`` and its address, else ``cpu``."""
    context = TaskContext.get()
    gpu = context.resources().get("gpu") if context else None
    return f"cuda:{gpu.addresses[0]}" if gpu and gpu.addresses else "cpu"


def task_profile(gpus: float = 1.0, cpus: int = 1) -> ResourceProfile:
    """What each task of a model's stage takes of an executor; half a GPU lets two share it.

    The executors' GPUs are those of the cluster's settings. A profile that asks for
    executors of its own can be built from Spark's classes and passed in its place.
    """
    tasks = TaskResourceRequests().cpus(cpus)
    return ResourceProfileBuilder().require(tasks.resource("gpu", gpus) if gpus else tasks).build


def stage_profile(spark: SparkSession, profile: ResourceProfile) -> ResourceProfile | None:
    """The profile, or none in local mode, where Spark refuses any."""
    master = spark.sparkContext.master
    return None if master == "local" or master.startswith("local[") else profile


def _scored_batches(
    load: Callable[..., Model], on_device: bool, window: int | None, size: int, max_failed: float
) -> Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]:
    """Texts in, (label, confidence) out, batch by batch."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _loaded(load, task_device() if on_device else None)
        seen = failed = 0
        for texts in batches:
            rows = [
                row
                for i in range(0, len(texts), size)
                for row in score_windows(model, list(texts.iloc[i : i + size]), window, size)
            ]
            seen += sum(t is not None for t in texts)
            failed += sum(
                t is not None and label is None
                for t, (label, _) in zip(texts, rows, strict=True)
            )
            if seen >= FAILURES_FROM and failed > max_failed * seen:
                raise RuntimeError(f"the model failed on {failed} of {seen} texts")
            yield pd.DataFrame(rows, columns=["label", "confidence"], index=texts.index)

    return run


@dataclass(frozen=True)
class ModelScorer:
    """Any batch model, called on Arrow batches.

    ``load`` returns the model and must be a module-level function, so that a worker
    recognises it and loads once. The model takes a list of texts and returns one
    (label, confidence) pair each. A text longer than ``window_chars``, the model's own input
    limit, is scored window by window and the windows' results are combined, so that the
    whole text counts. ``max_chars`` cuts texts instead, where a caller asks for that.
    Surrounding whitespace is removed first if ``strip`` is set.

    A text that fails gets a null label and does not disturb its neighbours. A task in
    which more than ``max_failed`` of at least ``FAILURES_FROM`` texts fail raises an error.

    With ``on_device``, ``load`` gets the task's device (``task_device``). With a ``profile``,
    the operators below run the model in a stage of its own, whose tasks take what it asks for:
    with a GPU each, there are as many models as GPUs, whatever the executors' cores.
    """

    load: Callable[..., Model]
    max_chars: int | None = None
    strip: bool = False
    batch_size: int = 64
    window_chars: int | None = None
    max_failed: float = 0.5
    on_device: bool = False
    profile: ResourceProfile | None = None

    expensive = True

    def __call__(self, content: Column) -> Column:
        run = self._run()

        @pandas_udf("label string, confidence double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            yield from run(batches)

        # Not deterministic in Spark's sense: a filter on the label must not be pushed
        # below the projection, where it would run the model a second time.
        return score.asNondeterministic()(self._input(content))

    def score_rows(self, rows: DataFrame, content: str, name: str) -> DataFrame:
        """The rows with the struct ``name`` in place of their text, scored under the profile."""
        run, keep = self._run(), [f for f in rows.schema.fields if f.name != content]
        flat = [T.StructField("label", T.StringType()), T.StructField("confidence", T.DoubleType())]

        def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # The model takes one batch at a time, so the last frame read is the scored one.
            last = []

            def texts() -> Iterator[pd.Series]:
                for frame in frames:
                    last[:] = [frame]
                    yield frame[content]

            for found in run(texts()):
                yield last[0].drop(columns=content).assign(**found)

        ready = rows.withColumn(content, self._input(F.col(content)))
        profile = stage_profile(rows.sparkSession, self.profile)
        scored = ready.mapInPandas(score, T.StructType([*keep, *flat]), profile=profile)
        return scored.select(*[f.name for f in keep], F.struct("label", "confidence").alias(name))

    def _run(self) -> Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]:
        return _scored_batches(
            self.load, self.on_device, self.window_chars, self.batch_size, self.max_failed
        )

    def _input(self, content: Column) -> Column:
        return text.clip(text.strip(content) if self.strip else content, self.max_chars)


def vote_model(load: Callable[..., Model], batch_size: int = 64, **options) -> ModelScorer:
    """A model for the vote, over whole texts in windows of the size that it reads.

    ``options``: further arguments of ``ModelScorer``, here and below.
    """
    return ModelScorer(
        load, strip=True, batch_size=batch_size, window_chars=VOTE_MODEL_CHARS, **options
    )


def impact_model(load: Callable[..., Model], batch_size: int = 64, **options) -> ModelScorer:
    """A model for the impact score, over title and content in windows that it reads."""
    return ModelScorer(load, batch_size=batch_size, window_chars=IMPACT_MODEL_CHARS, **options)


def score_windows(
    model: Model, texts: list[str], window: int | None, size: int
) -> list[tuple[str | None, float | None]]:
    """Score texts, each in windows of ``window`` characters.

    Of several windows, positive confidences count up and negative ones down; the sign of
    the sum is the label and its size over the number of windows the confidence. A text
    fails if one of its windows does.
    """
    if window is None:
        return score_batch(model, texts)
    parts = [
        [t[i : i + window] for i in range(0, max(len(t), 1), window)] if t is not None else [None]
        for t in texts
    ]
    flat = [part for one in parts for part in one]
    found = [
        row for i in range(0, len(flat), size) for row in score_batch(model, flat[i : i + size])
    ]
    rows, out = iter(found), []
    for one in parts:
        scored = [next(rows) for _ in one]
        if len(scored) == 1 or any(label is None for label, _ in scored):
            out.append(scored[0] if len(scored) == 1 else (None, None))
            continue
        signs = {"positive": 1, "negative": -1}
        total = sum(signs.get(label, 0) * confidence for label, confidence in scored)
        label = "positive" if total > 0 else "negative" if total < 0 else "neutral"
        out.append((label, abs(total) / len(scored)))
    return out


def score_batch(model: Model, texts: list[str]) -> list[tuple[str | None, float | None]]:
    """Score a batch; if it fails, text by text, so that only bad texts stay unscored."""
    present = [i for i, t in enumerate(texts) if t is not None]
    out: list[tuple[str | None, float | None]] = [(None, None)] * len(texts)
    try:
        for i, (label, confidence) in zip(
            present, model([texts[i] for i in present]), strict=True
        ):
            out[i] = (str(label).lower(), float(confidence))
    except MemoryError:
        raise
    except Exception:  # noqa: BLE001 - any model error means an unscored text
        if len(present) > 1:
            for i in present:
                out[i] = score_batch(model, [texts[i]])[0]
        else:
            return [(None, None)] * len(texts)
    return out


def score_texts(
    df: DataFrame, content: Column, scorer: Scorer, usable: Column, name: str = "_scored"
) -> DataFrame:
    """Add the scorer's struct, null where the text is not usable.

    A cheap scorer is a plain expression. An expensive one sees each distinct text once:
    texts are grouped by their 32-byte key, scored, and joined back on the key. Adaptive
    execution splits the rows of a hot text over many tasks.
    """
    if not _is_expensive(scorer):
        return df.withColumn(name, F.when(usable, scorer(content)))
    keyed = df.withColumn("_key", F.when(usable, text_key(content)))
    scored = _score_once(df.where(usable), content, scorer, name)
    return keyed.join(scored, "_key", "left").drop("_key")


def _is_expensive(scorer: Scorer) -> bool:
    return getattr(scorer, "expensive", True)


def _score_once(df: DataFrame, content: Column, scorer: Scorer, name: str) -> DataFrame:
    once = df.groupBy(text_key(content).alias("_key")).agg(F.first(content).alias("_text"))
    if getattr(scorer, "profile", None) is not None:
        return scorer.score_rows(once, "_text", name)
    return once.select("_key", scorer(F.col("_text")).alias(name))


def text_labels(
    news: DataFrame, scorer: Scorer, keep: Sequence[str], content: str = "content"
) -> DataFrame:
    """Kept columns, ``text_key`` and ``label`` of each article, without its text.

    Everything after this shuffles a 32-byte key in place of the article. Copies may
    remain; an expensive scorer still sees each distinct text once.
    """
    usable, body = text.has_scorable_text(content), F.col(content)
    rows = news.select(*keep, text_key(body).alias("text_key"), body, usable.alias("_usable"))
    if not _is_expensive(scorer):
        label = F.when(F.col("_usable"), F.lower(scorer(body)["label"]))
        return rows.select(*keep, "text_key", label.alias("label"))
    scored = _score_once(news.where(usable), body, scorer, "_scored").select(
        F.col("_key").alias("text_key"), F.lower("_scored.label").alias("label")
    )
    once = rows.select(*keep, "text_key").distinct()
    return once.join(scored, "text_key", "left").select(*keep, "text_key", "label")


def with_labels(news: DataFrame, scorer: Scorer, content: str = "content") -> DataFrame:
    """Add ``label`` for the vote; null for text that is blank, missing or failed to score."""
    usable = text.has_scorable_text(content)
    scored = score_texts(news, F.col(content), scorer, usable)
    return scored.withColumn("label", F.lower(F.col("_scored.label"))).drop("_scored")


def with_impact(news: DataFrame, scorer: Scorer) -> DataFrame:
    """Add ``impact_score`` in [-1, 1] from title and content together; 0 for blank text."""
    combined = text.title_and_content("title", "content")
    scored = score_texts(news, combined, scorer, ~text.is_blank(combined))
    score = labels.impact(F.lower(F.col("_scored.label")), "_scored.confidence")
    return scored.withColumn("impact_score", score).drop("_scored")


def impact_stats(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("impact_score").alias("n_scored"),
        F.round(F.min("impact_score"), 4).alias("min_impact"),
        F.round(F.max("impact_score"), 4).alias("max_impact"),
        F.round(F.avg("impact_score"), 4).alias("avg_impact"),
    )
