"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Only DataFrame functions. Documents are summed to cells (source, language, topic) with their
tokens. Each round scales the cells' weights to one marginal after the other: grouped sums of the
cells joined back, no window over all cells. The cells are written to the shared folder between
rounds. A document of a cell is kept with the probability min(1, rate x weight / tokens); the rate
is calibrated so that the expected tokens meet the budget, by sums over the cells for a grid of
rates that is narrowed a few times. A hash of the id decides, so that reruns keep the same rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import keep

MARGINS = ("source", "lang", "topic")
ROUNDS, TOLERANCE = 40, 1e-5
#: Share of the tokens to keep, and how far target shares are flattened: share ** FLATTEN, scaled to 1.
BUDGET, FLATTEN = 0.8, 0.8
GRID, NARROWINGS = 33, 6
SEED = 20_240_229
NONE = "(none)"


def topic_of(text: Column) -> Column:
    """Rough kind of a text by fixed marks, first match wins; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    marked = lambda *marks: reduce(or_, [t.contains(m) for m in marks])
    return (F.when(F.trim(t) == "", "empty").when(marked(" | "), "table").when(marked("###", "$$$", "%%%", "***"), "symbols")
            .when(marked("License", "rights reserved"), "legal").when(marked("@", "+1 ("), "contact").when(F.length(t) < 800, "short")
            .when(F.length(t) > 5000, "long").otherwise("prose"))


def n_tokens(text: Column) -> Column:
    """Runs of characters other than space and tab to carriage return; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def marked(docs: DataFrame, topic: Column | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with _source, _lang and _topic (null is a category of its own) and _tokens."""
    parts = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col(text_col)) if topic is None else topic}
    return docs.withColumns({**{f"_{m}": F.coalesce(c.cast("string"), F.lit(NONE)) for m, c in parts.items()}, "_tokens": n_tokens(F.col(text_col))})


def flattened(cells: DataFrame, margin: str, power: float = FLATTEN) -> DataFrame:
    """Target shares of a marginal: its categories' token shares to a power, scaled to sum to 1."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))
    total = sums.agg(F.sum("share")).first()[0]
    return sums.withColumn("share", F.col("share") / F.lit(total or 1.0))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (margins, tokens) with ``weight``: shares that sum to each target marginal.

    ``targets`` maps a margin to (margin, share); categories without tokens are left out and the
    other shares scaled up. Ends when no scaling of a round was off 1 by more than ``tolerance``
    or after ``rounds`` rounds: marginals that no weights can meet at once stay as close as then.
    """
    goal = cells.where("tokens > 0")
    total = goal.agg(F.sum("tokens")).first()[0]
    goal = goal.withColumn("weight", F.col("tokens") / F.lit(float(total or 1)))
    for m, t in targets.items():
        there = goal.select(m).distinct().join(t, m)
        all_ = there.agg(F.sum("share")).first()[0]
        goal = goal.join(there.withColumn(f"_{m}_goal", F.col("share") / F.lit(all_ or 1.0)).drop("share"), m, "left").fillna(0.0, [f"_{m}_goal"])
    now = keep(goal.withColumn("_off", F.lit(0.0)), "cells")
    for _ in range(rounds if total else 0):
        now = now.withColumn("_off", F.lit(0.0))
        for m in targets:
            sums = now.groupBy(m).agg(F.sum("weight").alias("_sum"))
            scale = F.when(F.col("_sum") > 0, F.col(f"_{m}_goal") / F.col("_sum")).otherwise(0.0)
            now = now.join(sums, m).withColumns({"weight": F.col("weight") * scale, "_off": F.greatest("_off", F.when(F.col("_sum") > 0, F.abs(scale - 1)).otherwise(0.0))}).drop("_sum")
        now = keep(now, "cells")
        if now.agg(F.max("_off")).first()[0] <= tolerance:
            break
    return now.drop("_off", *[f"_{m}_goal" for m in targets])


def calibrate(cells: DataFrame, budget: float) -> float:
    """The rate at which the expected kept tokens are ``budget`` of all; infinite if every document is needed."""
    heavy = F.col("weight") / F.col("tokens")
    s = cells.where("weight > 0").agg(F.sum("tokens").alias("t"), F.min(heavy).alias("low"), F.max(heavy).alias("high")).first()
    all_ = cells.agg(F.sum("tokens")).first()[0] or 0
    want = budget * all_
    if not s.t or want >= s.t:
        return float("inf")
    low, high = 0.0, 1.0 / s.low
    for _ in range(NARROWINGS):
        rates = [low + (high - low) * k / (GRID - 1) for k in range(GRID)]
        got = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.lit(r) * heavy)).alias(f"r{k}") for k, r in enumerate(rates)]).first()
        at = max(1, next((k for k in range(GRID) if got[k] >= want), GRID - 1))
        low, high = rates[at - 1], rates[at]
    return (low + high) / 2


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, topic: Column | None = None, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs`` with _topic, _tokens, _weight (of a token, 1 on average), _prob, _kept.

    Null categories are the category "(none)". A document without tokens is kept and weighs
    nothing. A null id is hashed like any; rows with one id share one fate. An empty table gives
    no rows. Columns that have these names are replaced.
    """
    tagged = marked(docs.drop("_topic", "_tokens", "_weight", "_prob", "_kept", "_source", "_lang"), topic)
    cells = keep(tagged.groupBy(*[F.col(f"_{m}").alias(m) for m in MARGINS]).agg(F.sum("_tokens").alias("tokens")), "cell-tokens")
    targets = targets or {m: flattened(cells, m) for m in MARGINS}
    raked = rake(cells, targets)
    rate = calibrate(raked, budget)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    heavy = F.col("weight") / F.col("tokens")
    prob = F.when(F.col("weight") <= 0, 0.0).otherwise(F.lit(1.0) if rate == float("inf") else F.least(F.lit(1.0), F.lit(rate) * heavy))
    chances = raked.select(*[F.col(m).alias(f"_{m}") for m in MARGINS], (heavy * F.lit(total)).alias("_weight"), prob.alias("_prob"))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / F.lit(float(1 << 53))
    free = F.col("_tokens") == 0
    return (tagged.join(chances, [f"_{m}" for m in MARGINS], "left")
            .withColumns({"_weight": F.when(free, 0.0).otherwise(F.coalesce("_weight", F.lit(0.0))), "_prob": F.when(free, 1.0).otherwise(F.coalesce("_prob", F.lit(0.0)))})
            .withColumn("_kept", draw < F.col("_prob")))
