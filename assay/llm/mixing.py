"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised. The exponent is
bisected between 1 (weights in proportion) and 0 (all sources alike) until the weights meet a
target entropy or the smallest source is repeated as often as allowed. The weights are realised
as permutations of blocks: documents are hashed into blocks, every pass over a source takes its
blocks in an order of its own, and the last pass ends where the source's budget does.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.shared import all_columns, stored, unused, words_of

BLOCK_TOKENS = 1 << 20
SECTIONS = 16
ROUNDS = 10
SEED = 17
LAST_POSITION = 1 - 2.0 ** -53


def powers(sources: DataFrame, exponents: list[float]) -> list[dict[str, float]]:
    """For every exponent, in one pass over the sources: the sum of share^e, of its share * log,
    and the largest and smallest budget a share gets, all over ``tokens > 0``."""
    total = float(sources.agg(F.sum("tokens").alias("t")).first()["t"])
    share = F.col("tokens") / F.lit(total)
    sums = []
    for i, exponent in enumerate(exponents):
        power = F.pow(share, F.lit(exponent))
        sums += [
            F.sum(power).alias(f"sum_{i}"),
            F.sum(power * F.log(power)).alias(f"log_{i}"),
            F.max(power / share).alias(f"most_{i}"), F.min(power / share).alias(f"least_{i}"),
        ]
    row = sources.agg(*sums).first().asDict()
    return [
        {name: row[f"{name}_{i}"] for name in ("sum", "log", "most", "least")}
        for i in range(len(exponents))
    ]


def entropy(found: dict[str, float]) -> float:
    """Entropy in nats of the normalised weights: log(sum) - sum(w log w) / sum."""
    return math.log(found["sum"]) - found["log"] / found["sum"]


def repetition(found: dict[str, float]) -> float:
    """How often the most repeated source is passed when the least repeated is passed once."""
    return found["most"] / found["least"]


def bisect_exponent(sources: DataFrame, holds: Callable[[dict[str, float]], bool]) -> float:
    """Smallest exponent in [0, 1] at which ``holds``, which must hold towards 1 if anywhere.

    Every round evaluates a row of exponents between the bounds in one pass, so the bracket
    shrinks by ``SECTIONS`` at a time. 1 if it holds nowhere.
    """
    at_zero, at_one = powers(sources, [0.0, 1.0])
    if holds(at_zero):
        return 0.0
    if not holds(at_one):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        between = [low + (high - low) * i / SECTIONS for i in range(1, SECTIONS)]
        fits = [holds(found) for found in powers(sources, between)]
        first = fits.index(True) if True in fits else len(between)
        low, high = (
            between[first - 1] if first else low,
            between[first] if first < len(between) else high,
        )
        if high - low < 1e-12:
            break
    return high


def source_budgets(
    documents: DataFrame, max_passes: float | None = 2.0, target_entropy: float | None = None,
    budget_tokens: float | None = None,
) -> DataFrame:
    """``source, tokens, weight, passes``: the token budget of a source is ``passes * tokens``.

    The exponent is the smallest at which no source is passed more than ``max_passes`` times as
    often as another, or the one at which the weights have ``target_entropy`` (nats), if that is
    larger; 1 without either limit. Without ``budget_tokens`` the budget is the smallest that passes
    every source at least once.
    """
    sources = documents.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    filled = stored(sources.where("tokens > 0"), "sources")
    if filled.isEmpty():
        return filled.select("source", "tokens", F.lit(0.0).alias("weight"), F.lit(1.0).alias("passes"))
    wanted = []
    if max_passes is not None:
        wanted.append(bisect_exponent(filled, lambda found: repetition(found) <= max_passes))
    if target_entropy is not None:
        # Entropy falls towards 1; the smallest exponent that no longer exceeds the target.
        wanted.append(bisect_exponent(filled, lambda found: entropy(found) <= target_entropy))
    exponent = max(wanted, default=1.0)
    found = powers(filled, [exponent])[0]
    total = float(filled.agg(F.sum("tokens").alias("t")).first()["t"])
    share = F.col("tokens") / F.lit(total)
    weight = F.pow(share, F.lit(exponent)) / F.lit(found["sum"])
    # passes = weight * budget / tokens; least is the smallest weight / share, before normalising.
    budget = budget_tokens or total * found["sum"] / found["least"]
    return filled.select(
        "source", "tokens", weight.alias("weight"),
        # Rounded, so that a source passed exactly once is not short of its last document.
        F.round(weight * F.lit(float(budget)) / F.col("tokens"), 9).alias("passes"),
    )


def shuffled(*parts: Column) -> Column:
    return F.xxhash64(*parts, F.lit(SEED))


def unit_interval(*names: str) -> Column:
    """A number in [0, 1) from the upper bits of a hash."""
    bits = F.shiftrightunsigned(shuffled(*map(F.col, names)), 11)
    return bits.cast("double") / F.lit(2.0 ** 53)


def mix_sources(
    documents: DataFrame, max_passes: float | None = 2.0, target_entropy: float | None = None,
    budget_tokens: float | None = None, block_tokens: int = BLOCK_TOKENS,
    tokens: Column | None = None,
) -> DataFrame:
    """``documents`` in the mixture: a row per document and pass, with ``mix_pass``, ``mix_block``,
    ``mix_tokens`` and ``mix_position``.

    ``mix_position`` lies in [0, 1): a block of a pass takes the stretch of its source's budget that
    its place in the pass's order gives it, and its documents are spread over the stretch by hash.
    Sorted by it, every long stretch of the result holds the sources in their weights. Whole passes take every document; the last, partial one takes whole blocks in
    the pass's order and of the block in which the budget ends documents in hash order up to
    the first that does not fit, then the others by size as long as they fit; those larger than the
    room are left out. A NULL source is a source of its own. ``tokens`` is the size of a document, its words if
    not given. Documents without tokens weigh nothing and come once; so do all documents if no
    source has tokens. Repeated rows are rows of their own, but rows equal in id, source and text
    stay or go together. With ``budget_tokens`` a source may be passed less than once. Columns of
    ``documents`` keep their names; a result's name that one of them has ends in ``_``.
    """
    size = words_of(F.col("text")) if tokens is None else tokens
    sized = documents.select(
        F.struct(*all_columns(documents)).alias("row"),
        F.struct(F.col("source").isNull().alias("none"), F.col("source").alias("name")).alias(
            "source"
        ),
        F.coalesce(size, F.lit(0)).cast("long").alias("tokens"),
        F.xxhash64("doc_id", "text").alias("name"),
    )
    keys = stored(sized.select("source", "tokens", "name"), "mix-keys")
    budgets = stored(
        source_budgets(keys, max_passes, target_entropy, budget_tokens).withColumnRenamed(
            "tokens", "source_tokens"
        ).withColumn(
            "blocks",
            F.greatest(F.ceil(F.col("source_tokens") / F.lit(block_tokens)), F.lit(1)),
        ),
        "budgets",
    )
    block = F.pmod(shuffled(F.col("name")), F.col("blocks"))
    blocks = stored(
        keys.where("tokens > 0").join(budgets, "source").groupBy(
            "source", block.alias("block"), "source_tokens", "passes"
        ).agg(F.sum("tokens").alias("block_tokens")),
        "blocks",
    )
    # A row per block and pass: blocks are few, and only they are put in order.
    passes = blocks.select(
        "*",
        F.explode(F.sequence(
            F.lit(0).cast("long"), F.greatest(F.ceil("passes") - 1, F.lit(0).cast("long"))
        )).alias("mix_pass"),
    )
    in_pass = Window.partitionBy("source", "mix_pass").orderBy(
        shuffled(F.col("source.name"), F.col("mix_pass"), F.col("block")), "block"
    ).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("block_tokens").over(in_pass), F.lit(0))
    taken = passes.withColumns({
        "begin": F.col("mix_pass") * F.col("source_tokens") + before,
        "budget": F.col("passes") * F.col("source_tokens"),
    }).withColumn("room", F.round(F.col("budget") - F.col("begin"), 3)).where("room > 0").select(
        "source", "block", "mix_pass", "room", "block_tokens",
        (F.col("begin") / F.col("budget")).alias("start"),
        (F.least("block_tokens", "room") / F.col("budget")).alias("stretch"),
    )
    # One row per block with the passes that take it; then every document meets one row.
    plan = taken.groupBy("source", "block").agg(
        F.collect_list(F.struct("mix_pass", "room", "block_tokens", "start", "stretch")).alias("takes")
    )
    dealt = sized.join(budgets.select("source", "blocks"), "source", "left").withColumn(
        "block", F.when(F.col("tokens") > 0, block)
    )
    whole = F.filter("takes", lambda t: t["room"] >= t["block_tokens"])
    cut = F.filter("takes", lambda t: t["room"] < t["block_tokens"])
    once = F.array(F.struct(
        F.lit(0).cast("long").alias("mix_pass"), F.lit(0.0).alias("room"),
        F.lit(0).cast("long").alias("block_tokens"), F.lit(0.0).alias("start"),
        F.lit(1.0).alias("stretch"),
    ))
    met = dealt.join(plan, ["source", "block"], "left").select(
        "row", "source", "block", "tokens", "name",
        F.when(F.col("block").isNull(), once).otherwise(whole).alias("whole"), cut.alias("cut"),
    )
    columns = [F.col("row")[c].alias(c) for c in documents.columns]
    result = [
        *columns, F.col("take.mix_pass").cast("int").alias(unused(documents, "mix_pass")),
        F.col("block").alias(unused(documents, "mix_block")),
        F.col("tokens").alias(unused(documents, "mix_tokens")),
        F.least(
            F.col("take.start") + F.col("take.stretch") * unit_interval("name", "take.mix_pass"),
            F.lit(LAST_POSITION),
        ).alias(unused(documents, "mix_position")),
    ]
    in_whole = met.select("*", F.explode("whole").alias("take")).select(*result)
    # Only the blocks in which a budget ends are put in order. Rows of one name go together.
    cut_block = Window.partitionBy("source", "block", "take.mix_pass")
    room = F.col("take.room")
    in_part = met.select("*", F.explode("cut").alias("take")).withColumn(
        "unit", F.sum("tokens").over(cut_block.orderBy("name").rangeBetween(0, 0))
    ).withColumn(
        "early", F.coalesce(F.sum(F.when(F.col("unit") <= room, F.col("tokens"))).over(
            cut_block.orderBy("name").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        ) <= room, F.lit(False)) & (F.col("unit") <= room)
    ).withColumn(
        "through", F.sum("tokens").over(
            cut_block.orderBy(
                F.col("early").desc(), F.when(F.col("early"), F.lit(0)).otherwise(F.col("unit")),
                "name",
            ).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        )
    ).where(F.col("through") <= room).select(*result)
    return in_whole.unionByName(in_part)
