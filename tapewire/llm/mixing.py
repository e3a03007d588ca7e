"""Temperature mixing of sources: flatten their shares, then draw whole documents.

1. Shares of the sources among all tokens are raised to an exponent and scaled to sum to 1.
   At 1 the mixture is the corpus's own, towards 0 all sources weigh the same. The exponent is
   bisected for a least entropy, and raised again where a source would repeat too often.
2. Weights times the number of tokens to draw are the sources' budgets.
3. The documents of a source are dealt to blocks by a hash, in number by the source's tokens, and
   permuted within a block. A block is repeated as often as its source's budget holds it, and
   the rest of the budget takes the block's first documents. Blocks are bounded, so no
   task holds more than one block of a source, however large the source is.

The bisection reads sums over the sources only, and eight exponents at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.llm.store import Scratch

BLOCK_TOKENS = 1_000_000
SEED = "mix"
# Halvings of the interval at a time, and in all; the exponent is rounded to DIGITS.
STEP, STEPS, DIGITS = 3, 10, 6


def n_tokens(text: str | Column = "text") -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def source_totals(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, tokens, share) of each source; a null source is a source of its own."""
    totals = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    totals = scratch.save(totals, "totals")
    everything = totals.agg(F.sum("tokens").alias("n")).first()["n"] or 1
    return totals.select("source", "tokens", (F.col("tokens") / F.lit(everything)).alias("share"))


def _measures(totals: DataFrame, exponents: list[float], budget_share: float) -> list[tuple]:
    """(entropy, most repetitions) at each exponent."""
    share = F.col("share")
    sums = []
    for i, a in enumerate(exponents):
        sums += [
            F.sum(F.pow(share, F.lit(a))).alias(f"z{i}"),
            F.sum(F.pow(share, F.lit(a)) * F.ln(share)).alias(f"s{i}"),
            F.max(F.pow(share, F.lit(a - 1))).alias(f"m{i}"),
        ]
    row = totals.where("share > 0").agg(*sums).first()
    return [
        (
            math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"],
            budget_share * row[f"m{i}"] / row[f"z{i}"],
        )
        for i, a in enumerate(exponents)
    ]


def _bisect(totals: DataFrame, low: float, budget_share: float, holds) -> tuple[float, float]:
    """The last exponent from ``low`` to 1 where ``holds`` is as at ``low``, and the next."""
    high, parts = 1.0, 1 << STEP
    for _ in range(STEPS):
        inner = [low + (high - low) * i / parts for i in range(1, parts)]
        found = _measures(totals, inner, budget_share)
        passed = [a for a, m in zip(inner, found, strict=True) if holds(*m)]
        failed = [a for a, m in zip(inner, found, strict=True) if not holds(*m)]
        low, high = max(passed, default=low), min(failed, default=high)
    return low, high


def exponent(
    totals: DataFrame,
    target_entropy: float | None,
    max_repeats: float | None,
    budget_share: float = 1.0,
) -> float:
    """The exponent, from 0 to 1, for saved ``totals``.

    ``target_entropy``: least entropy as a share of the greatest, that of equal weights.
    ``max_repeats``: how often a source's tokens may be drawn, on average; it goes before the
    entropy. ``budget_share``: tokens to draw per token of the corpus.
    """
    n = totals.where("share > 0").count()
    if n == 0:
        return 1.0
    scale = 10**DIGITS
    found = 1.0
    if target_entropy is not None:
        least = target_entropy * math.log(n)
        if _measures(totals, [1.0], budget_share)[0][0] < least:
            low, _ = _bisect(totals, 0.0, budget_share, lambda h, _: h >= least)
            found = math.floor(low * scale) / scale
    if max_repeats is not None:
        if budget_share > max_repeats:
            raise ValueError("the budget repeats the whole corpus more often than allowed")
        if _measures(totals, [found], budget_share)[0][1] > max_repeats:
            _, high = _bisect(totals, found, budget_share, lambda _, r: r > max_repeats)
            found = min(math.ceil(high * scale) / scale, 1.0)
    return found


def is_even(totals: DataFrame, target_entropy: float | None) -> bool:
    """Whether the sources have the entropy as they are, so that there is nothing to mix."""
    n = totals.where("share > 0").count()
    if target_entropy is None or n == 0:
        return True
    return _measures(totals, [1.0], 1.0)[0][0] >= target_entropy * math.log(n)


def weights(totals: DataFrame, power: float, budget_share: float = 1.0) -> DataFrame:
    """(source, weight, repeats, blocks) of each source.

    ``repeats``: how often its tokens are drawn. A source without tokens has weight 0.
    """
    raised = F.when(F.col("share") > 0, F.pow("share", F.lit(power))).otherwise(F.lit(0.0))
    scale = totals.agg(F.sum(raised).alias("z")).first()["z"] or 1.0
    weight = raised / F.lit(scale)
    return totals.select("source", "tokens", "share", weight.alias("weight")).select(
        "source",
        "weight",
        F.when(F.col("share") > 0, F.round(F.col("weight") * budget_share / F.col("share"), 9))
        .otherwise(F.lit(0.0))
        .alias("repeats"),
        F.greatest(F.ceil(F.col("tokens") / BLOCK_TOKENS), F.lit(1)).alias("blocks"),
    )


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget_share: float = 1.0,
    whole_if_even: bool = False,
) -> DataFrame:
    """The rows of ``docs`` as often as they are drawn, with their place in the mixture.

    Needs doc_id, text and source; keeps all columns and adds n_tokens, weight, copy (0 for the
    first time), block, place (tokens before it in its block) and turn, a hash of source, block
    and copy. Sorted by turn and place, the rows are the mixture, blocks of all sources in
    random order. Columns of ``docs`` with these names are replaced.

    ``whole_if_even``: where the sources have the entropy as they are, draw each document once
    or more, also if ``budget_share`` is less than 1.

    A block's last document is drawn if the middle of it lies within the budget. A null source
    is a source of its own; null and empty texts have no tokens and are drawn with the block
    around them; a source without any tokens is not drawn. Repeated rows are drawn one by
    one. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    key = F.md5(F.concat_ws(":", F.lit(SEED), "doc_id", F.md5(F.coalesce("text", F.lit("")))))
    rows = docs.withColumns({"n_tokens": n_tokens(), "_key": key})
    totals = source_totals(rows.select("source", "n_tokens"), scratch)
    if whole_if_even and is_even(totals, target_entropy):
        budget_share = max(budget_share, 1.0)
    power = exponent(totals, target_entropy, max_repeats, budget_share)
    # Written, so that its size is known when the join is planned.
    per_source = scratch.save(weights(totals, power, budget_share), "weights").withColumnsRenamed(
        {"source": "_source", "weight": "_weight"}
    )
    number = F.conv(F.substring("_key", 25, 8), 16, 10).cast("long")
    replaced = ["weight", "copy", "block", "place", "turn"]
    dealt = rows.drop(*replaced, "repeats", "blocks").join(
        per_source, F.col("source").eqNullSafe(F.col("_source"))
    ).withColumn("block", F.pmod(number, F.col("blocks")))
    block = Window.partitionBy("source", "block")
    placed = dealt.withColumns(
        {
            "place": F.sum("n_tokens").over(
                block.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("n_tokens"),
            "_tokens": F.sum("n_tokens").over(block),
        }
    )
    whole = F.floor("repeats")
    rest = (F.col("repeats") - whole) * F.col("_tokens")
    middle = F.col("place") + F.col("n_tokens") / 2
    copies = (whole + (middle < rest).cast("long")).cast("int")
    drawn = placed.withColumn("_copies", copies).where("_copies > 0")
    drawn = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    turn = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce("source", F.lit("")), "block", "copy"))
    return drawn.withColumns({"weight": F.col("_weight"), "turn": turn}).drop(
        "_key", "_source", "_weight", "_tokens", "_copies", "repeats", "blocks"
    )
