"""Mix sources to target amounts of words by entropy balancing.

Every document starts from the same rate and is tilted by ``exp(multiplier * size)``, up to
``most`` copies: the rates of least relative entropy whose words add up to each source's
target. The multipliers solve a convex dual by Newton steps; each step is one aggregation over
(source, size) counts. Rates become whole copies by a threshold on a hash of the document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tools import WORD, stored, unit, whole_row

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
_BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``target`` to ``source, words``: ``share`` of all words by weight, none above ``most`` times its words.

    Weights repeat over the sources by code point, null last. What exceeds a limit is dealt
    again by weight, until no source is above: sources that reach the limit are those with the
    lowest limit per weight. The windows hold one row per source, not documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn("limit", F.col("words") * float(most))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy(F.lit(0))
    level = (F.sum("words").over(everyone) * float(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    )
    leveled = weighed.withColumn("level", level)
    free = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("limit", "weight", "level"))
    first = F.min_by(F.col("level"), F.when(free.isNotNull(), F.col("limit") / F.col("weight"))).over(everyone)
    share_of = F.coalesce(first, F.lit(float("inf"))) * F.col("weight")
    return leveled.withColumn("target", F.least(F.col("limit"), share_of)).drop("weight", "limit", "level")


def _rate(multiplier: Column, size: Column, mean: Column, base: float, most: float) -> Column:
    exponent = F.least(multiplier * size / mean, F.lit(float(np.log(most / base))))
    return F.when(F.isnan(exponent), F.lit(base)).otherwise(F.lit(base) * F.exp(exponent))


def multipliers(sizes: DataFrame, goals: DataFrame, base: float, most: float, steps: int = 60, near: float = 1e-7) -> DataFrame:
    """Add ``multiplier`` to ``source, words, docs, target`` by guarded Newton steps over ``source, size, docs``.

    A step that leaves the bracket known to hold the root is replaced by its middle. The state
    is one row per source and is checkpointed after each step; the driver sees one number.
    """
    inf = float("inf")
    state = goals.select(
        "source", "words", "target", (F.col("words") / F.col("n_docs")).alias("mean"),
        # A target at the limit takes every copy, whatever the size.
        F.when(F.col("target") >= F.col("words") * most * (1 - 1e-12), inf).otherwise(0.0).alias("multiplier"),
        F.lit(-inf).alias("low"), F.lit(inf).alias("high"), F.lit(inf).alias("miss"),
    )
    state = stored(state, "mix-start")
    for _ in range(steps):
        rows = sizes.alias("h").join(
            F.broadcast(state).alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")) & (F.col("s.miss") > near)
        )
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), base, most)
        words = F.col("docs") * F.col("size") * rate
        slope = F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = rows.groupBy(F.col("h.source").alias("of")).agg(F.sum(words).alias("taken"), F.sum(slope).alias("slope"))
        at = state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
        gap = F.col("taken") - F.col("target")
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        low = F.when(gap > 0, F.col("low")).otherwise(F.col("multiplier"))
        newton = F.col("multiplier") - F.when(F.col("slope") > 0, gap / F.col("slope"))
        middle = (
            F.when(high == inf, low * 2 + 1).when(low == -inf, high * 2 - 1).otherwise((low + high) / 2)
        )
        moved = F.when(newton.isNotNull() & (newton > low) & (newton < high), newton).otherwise(middle)
        miss = F.abs(gap) / F.greatest(F.col("target"), F.lit(1e-9))
        settled = F.col("taken").isNull() | (F.col("words") == 0) | (F.abs(F.col("multiplier")) == inf)
        done = settled | (miss <= near)
        state = at.select(
            "source", "words", "target", "mean",
            F.when(done, F.col("multiplier")).otherwise(moved).alias("multiplier"),
            F.when(done, F.col("low")).otherwise(low).alias("low"),
            F.when(done, F.col("high")).otherwise(high).alias("high"),
            F.when(settled, 0.0).when(done, F.least("miss", miss)).otherwise(miss).alias("miss"),
        )
        state = stored(state, "mix-step")
        if (state.agg(F.max("miss")).first()[0] or 0.0) <= near:
            break
    return state.select("source", "words", "target", "mean", F.round("multiplier", 10).alias("multiplier"))


def _cuts(rows: pd.DataFrame) -> pd.DataFrame:
    """Up to which bin documents of each size class take one copy more, for one source.

    From the largest class down, what one class takes too much or too little is left to the
    next, so the error ends at the size of small documents.
    """
    out, carry = [], 0.0
    for size_class, part in sorted(rows.groupby("size_class"), key=lambda item: -item[0]):
        part = part.sort_values("bin")
        taken = np.concatenate(([0.0], part["words"].cumsum().to_numpy(dtype=float)))
        want = float(part["want"].sum()) + carry
        best = int(np.abs(taken - want).argmin())
        carry = want - taken[best]
        cut = int(part["bin"].iloc[best - 1]) if best else -_BINS - 1
        out.append((rows["source"].iloc[0], int(size_class), cut))
    return pd.DataFrame(out, columns=["source", "size_class", "cut"])


def with_copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, key: str = "doc_id") -> DataFrame:
    """``row, mix``: every row of ``docs`` as a struct, and a struct of ``size, source_size, target, rate, copies``.

    Null and empty texts have size 0 and no copies; null is a source of its own; rows that
    share a key count one by one and take equal copies if equal in size and source. A source
    without words has target 0. An empty table gives an empty result. Rows keep all their columns.
    """
    if not 0 < share <= most:
        raise ValueError("share must be above 0 and at most the copies of a document")
    base = float(share)

    def placed(*columns: Column) -> DataFrame:
        inner = F.struct(F.col(key).alias("key"), F.col("source").alias("source"), word_count(F.col("text")).alias("size"))
        return docs.select(*columns, inner.alias("mix"))

    sizes = placed().select("mix.source", "mix.size").groupBy("source", "size").agg(F.count("*").alias("docs"))
    sizes = stored(sizes, "mix-histogram")
    sources = sizes.groupBy("source").agg(F.sum(F.col("docs") * F.col("size")).alias("words"), F.sum("docs").alias("n_docs"))
    state = multipliers(sizes, stored(targets(sources, weights, share, most), "mix-targets"), base, most)
    state = state.select(F.struct("source", "words", "target", "mean", "multiplier").alias("goal"))

    def rated(rows: DataFrame) -> DataFrame:
        """Add ``bin``: where the document stands among those of its source and size class that may take one copy more."""
        # Broadcast: one row per source.
        rows = rows.join(F.broadcast(state), F.col("mix.source").eqNullSafe(F.col("goal.source")))
        size = F.col("mix.size")
        rate = F.round(_rate(F.col("goal.multiplier"), size, F.col("goal.mean"), base, most), 9)
        rows = rows.withColumn("mix", F.col("mix").withField("rate", F.when(size > 0, rate).otherwise(0.0)))
        whole = F.floor("mix.rate")
        position = F.floor((unit(F.col("mix.key"), size) - F.col("mix.rate") + whole) * _BINS).cast("int")
        return rows.withColumn(
            "mix",
            F.col("mix")
            .withField("whole", whole)
            .withField("size_class", F.when(size > 0, F.floor(F.log2(size))).otherwise(-1).cast("int"))
            .withField("bin", F.when((whole < most) & (size > 0), position)),
        )

    part = F.col("rate") - F.col("whole")
    bins = rated(placed()).select("mix.*").filter("bin is not null").groupBy("source", "size_class", "bin").agg(
        F.sum("size").alias("words"), F.sum(part * F.col("size")).alias("want")
    )
    cuts = stored(bins.groupBy("source").applyInPandas(_cuts, "source string, size_class int, cut int"), "mix-cuts")
    # Broadcast: one row per source and power of two of the size.
    cuts = F.broadcast(cuts.select(F.struct("source", "size_class", "cut").alias("up_to")))
    same = F.col("mix.source").eqNullSafe(F.col("up_to.source")) & (F.col("mix.size_class") == F.col("up_to.size_class"))
    extra = F.coalesce((F.col("mix.bin") <= F.col("up_to.cut")).cast("int"), F.lit(0))
    result = F.struct(
        "mix.size", F.col("goal.words").alias("source_size"), "goal.target", "mix.rate", (F.col("mix.whole") + extra).cast("int").alias("copies")
    )
    return rated(placed(whole_row(docs).alias("row"))).join(cuts, same, "left").select("row", result.alias("mix"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, key: str = "doc_id") -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies`` of every row of ``docs``; see ``with_copies``."""
    rows = with_copies(docs.select(F.col(key).alias("doc_id"), "source", "text"), weights, share, most)
    return rows.select("row.doc_id", "row.source", "mix.*")


def repeated(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, key: str = "doc_id") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    rows = with_copies(docs, weights, share, most, key)
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("mix.copies")))).select("row.*")
