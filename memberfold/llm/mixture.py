"""Mixing sources to target weights by entropy balancing.

A document's rate is how often the mix takes it. Among all rates that meet each
source's target of words, with no rate above a cap, those of greatest entropy are
exponentially tilted: ``min(cap, exp(t x))``, with x the document's size over its
source's mean and one tilt t a source. The tilts minimise the convex dual whose
gradient is the words the rates take less the target; Newton steps, kept inside a
bracket, find them for all sources at once. A step reads only the counts of documents
by source and size. Rates are then rounded into copies by a threshold a source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from memberfold.llm.common import is_small, small, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
# The words that the rates take meet the target within this share of it.
CLOSE = 1e-6
MAX_STEPS = 60
# Parts an interval of thresholds is cut to, how often, and rounds over what is left.
PARTS, LEVELS, ROUNDS = 1024, 3, 3

_KEY, _SIZE, _PLAN, _MIX = "__mix_key", "__mix_size", "__mix_plan", "__mix"


def _named(source: Column) -> Column:
    """A join key in which the null source is a source like any other."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _hinted(df: DataFrame, few: bool) -> DataFrame:
    """A broadcast hint for a table of at most a row a source, if there are few sources."""
    return F.broadcast(df) if few else df


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, a row a source.

    Sources in code point order, null last, weigh ``weights``, repeating; together they
    get ``share`` of all sizes. A target stops at ``cap`` times its source's size and
    the excess goes to the others by weight until none is above. The rank is the one
    step over the whole table of sources: it has no document rows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (at + 1).cast("int"))
    ranked = written(sizes.withColumn("weight", weight), "sources")
    most = F.col("source_size") * cap
    level, full = 0.0, -1
    while True:
        closed = F.col("weight") * level >= most
        total, n, taken, free = ranked.agg(
            F.sum("source_size"),
            F.sum(closed.cast("long")),
            F.sum(F.when(closed, most)),
            F.sum(F.when(~closed, F.col("weight"))),
        ).first()
        if n == full or not free:
            break
        full, level = n, (share * (total or 0) - (taken or 0.0)) / free
    target = F.when(closed, most).otherwise(F.col("weight") * level)
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _rate(tilt: Column, x: Column, cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(F.least(tilt * x, F.lit(math.log(cap)))))


def tilts(histogram: DataFrame, targets: DataFrame, cap: float = CAP, few: bool = False) -> DataFrame:
    """``key, source_size, target, mean, tilt`` of every source that has words.

    ``histogram`` is ``key, size, n``: documents of a source by size, sizes above 0. The
    tilt is null where the target is all that the cap allows: every rate is the cap.
    ``few`` says that the targets may be broadcast. A step is one query, whose write also
    tells how many sources are still off their targets.
    """
    sums = histogram.groupBy("key").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    x_least = F.col("least") / F.col("mean")
    ratio = F.col("target") / F.col("source_size")
    state = targets.join(sums, "key").select(
        "key", "source_size", "target", "mean",
        (ratio >= cap * (1 - CLOSE)).alias("full"),
        F.lit(0.0).alias("tilt"),
        F.when(ratio < 1, F.log(ratio) / x_least).otherwise(F.lit(0.0)).alias("low"),
        F.when(ratio > 1, F.lit(math.log(cap)) / x_least).otherwise(F.lit(0.0)).alias("high"),
        F.lit(1.0).alias("gap"),
    )
    state = written(state.where("target > 0"), "tilts")
    for _ in range(MAX_STEPS):
        off = Observation()
        step = _stepped(histogram, state.drop("gap"), cap, few)
        state = written(step.observe(off, F.count(F.when(F.col("gap") > 0, 1)).alias("n")), "tilts")
        if not off.get["n"]:
            break
    tilt = F.when(~F.col("full"), F.col("tilt"))
    return state.select("key", "source_size", "target", "mean", tilt.alias("tilt"))


def _stepped(histogram: DataFrame, state: DataFrame, cap: float, few: bool) -> DataFrame:
    """The state of each source after a Newton step, or halving where that leaves the bracket."""
    x = F.col("size") / F.col("mean")
    words = F.col("size") * F.col("n") * _rate(F.col("tilt"), x, cap)
    moving = F.col("tilt") * x < math.log(cap)
    # A source's state goes along as keys of the group, so that it need not be joined again.
    sums = (
        histogram.join(_hinted(state, few), "key")
        .groupBy(*state.columns)
        .agg(F.sum(words).alias("took"), F.sum(F.when(moving, words * x)).alias("slope"))
    )
    over = F.col("took") > F.col("target")
    low = F.when(over, F.col("low")).otherwise(F.col("tilt"))
    high = F.when(over, F.col("tilt")).otherwise(F.col("high"))
    gap = F.abs(F.col("took") / F.col("target") - 1)
    newton = F.col("tilt") - F.log(F.col("took") / F.col("target")) * F.col("took") / F.col("slope")
    inside = (newton > low) & (newton < high)
    better = F.when(inside, newton).otherwise((low + high) / 2)
    done = F.col("full") | (gap <= CLOSE)
    return sums.select(
        "key", "source_size", "target", "mean", "full",
        F.when(done, F.col("tilt")).otherwise(better).alias("tilt"),
        low.alias("low"), high.alias("high"),
        F.when(done, F.lit(0.0)).otherwise(gap).alias("gap"),
    )


def _chance(identity: Sequence[Column]) -> Column:
    """A number from 0 to 1 (not 0) that depends only on the document."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(17), *identity), 11)
    return (bits + 1) / float(1 << 53)


def _copies(size: Column, rank: Column, mean: Column, tilt: Column, cap: float) -> tuple[Column, Column]:
    """Whole copies of a document, and its order among those that may get one more.

    The order is its chance over the fraction of a copy left, brought below 1; it is 1
    where nothing is left.
    """
    rate = F.when(tilt.isNull(), F.lit(cap)).otherwise(_rate(tilt, size / mean, cap))
    rate = F.when((size > 0) & mean.isNotNull(), rate).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    odds = rank / (rate - whole)
    return whole, F.when(rate > whole, odds / (1 + odds)).otherwise(F.lit(1.0))


def plan_mixture(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """One row a source: ``key, source_size, target, mean, tilt, cuts``.

    ``sized`` is ``key, source, size, rank``. ``cuts`` lists (threshold, largest size): a
    document gets a copy beyond its whole ones if its order stays below the threshold of
    an entry and its size within the entry's. This is sequential Poisson sampling
    (smallest chance over probability first) stopped short of the target; each round
    goes on among the smaller documents to fill what the last one left.
    """
    sizes = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes.select("source", "source_size"), weights, share, cap)
    targets = targets.withColumn("key", _named(F.col("source"))).drop("source")
    few = is_small(targets)
    histogram = written(
        sized.where("size > 0").groupBy("key", "size").agg(F.count("*").alias("n")), "histogram"
    )
    tilted = tilts(histogram, targets, cap, few)
    plan = targets.join(tilted.select("key", "mean", "tilt"), "key", "left")
    joined = sized.select("key", "size", "rank").join(_hinted(plan, few), "key")
    whole, order = _copies(F.col("size"), F.col("rank"), F.col("mean"), F.col("tilt"), cap)
    ordered = written(
        joined.select("key", "size", whole.alias("whole"), order.alias("order")), "orders"
    )
    needs = ordered.groupBy("key").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"))
    state = plan.join(needs, "key").select(
        *plan.columns,
        (F.col("target") - F.col("sure")).alias("need"),
        F.array().cast("array<struct<below:double,largest:double>>").alias("cuts"),
    )
    state = written(state, "mix")
    loose = ordered.where("order < 1")
    for _ in range(ROUNDS):
        state = state.withColumns(
            {"largest": F.col("need").cast("double"), "low": F.lit(0.0), "width": F.lit(1.0)}
        )
        for _ in range(LEVELS):
            state = written(_narrowed(loose, state, few), "mix")
        cut = F.struct(F.col("low").alias("below"), "largest")
        state = state.withColumn("cuts", F.concat("cuts", F.array(cut)))
        state = state.drop("largest", "low", "width")
    return state.drop("need")


def _taken(order: Column, size: Column, cuts: Column) -> Column:
    return F.exists(cuts, lambda c: (order < c["below"]) & (size <= c["largest"]))


def _narrowed(loose: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """Move each source's interval to the part in which what it needs is exceeded."""
    part = F.floor((F.col("order") - F.col("low")) / F.col("width") * PARTS).cast("int")
    inside = (F.col("order") >= F.col("low")) & (F.col("order") < F.col("low") + F.col("width"))
    parts = (
        loose.join(_hinted(state.select("key", "need", "low", "width", "largest", "cuts"), few), "key")
        .where(inside & (F.col("size") <= F.col("largest")))
        .where(~_taken(F.col("order"), F.col("size"), F.col("cuts")))
        .groupBy("key", "need", part.alias("part"))
        .agg(F.sum("size").alias("words"))
    )
    upto = Window.partitionBy("key").orderBy("part")  # at most PARTS rows a source
    running = parts.withColumn("upto", F.sum("words").over(upto))
    fits = F.col("upto") <= F.col("need")
    passed = running.groupBy("key").agg(
        F.min(F.when(~fits, F.col("part"))).alias("at"),
        F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("used"),
    )
    moved = state.join(_hinted(passed, few), "key", "left")
    low = F.col("low") + F.col("width") * F.coalesce(F.col("at"), F.lit(0)) / PARTS
    # Without a part that exceeds the need everything in the interval is taken.
    low = F.when(F.col("used").isNotNull() & F.col("at").isNull(), F.col("low") + F.col("width")).otherwise(low)
    width = F.when(F.col("at").isNotNull(), F.col("width") / PARTS).otherwise(F.lit(0.0))
    return moved.select(
        *[c for c in state.columns if c not in ("low", "width", "need")],
        low.alias("low"),
        width.alias("width"),
        (F.col("need") - F.coalesce(F.col("used"), F.lit(0))).alias("need"),
    )


def mixture(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """The documents, whole rows, with ``size, source_size, target, copies``.

    The result's four columns replace columns of the documents with these names. A
    document without words (or text) has size 0 and no copies. Rows that repeat a
    document share its chance, so they are taken alike. A null source is a source of its
    own. Reruns agree: chances come from doc_id and size.
    """
    own = [c for c in documents.columns if c not in ("size", "source_size", "target", "copies")]
    return _mixed(documents, weights, share, cap).select(*own, f"{_MIX}.*")


def _mixed(documents: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """The documents, all their columns, with what is found in one struct of a reserved name."""
    ranked = documents.select(
        "*", word_count("text").alias(_SIZE), _named(F.col("source")).alias(_KEY)
    )
    chance = _chance([F.col("doc_id"), F.col(_SIZE)])
    sized = written(
        ranked.select(
            F.col(_KEY).alias("key"), "source", F.col(_SIZE).alias("size"), chance.alias("rank")
        ),
        "sizes",
    )
    plan = plan_mixture(sized, weights, share, cap)
    packed = plan.select(F.col("key").alias(_KEY), F.struct("*").alias(_PLAN))
    size, of = F.col(_SIZE), F.col(_PLAN)
    whole, order = _copies(size, chance, of["mean"], of["tilt"], cap)
    more = F.coalesce(_taken(order, size, of["cuts"]) & (order < 1), F.lit(False))
    found = F.struct(
        size.alias("size"),
        of["source_size"].alias("source_size"),
        of["target"].alias("target"),
        (whole + more.cast("long")).alias("copies"),
    )
    return ranked.join(small(packed), _KEY).select(*documents.columns, found.alias(_MIX))


def mixed_documents(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """The mix itself: every document as often as it has copies, with the columns it came with."""
    copied = _mixed(documents, weights, share, cap)
    times = F.sequence(F.lit(1), F.col(f"{_MIX}.copies").cast("int"))
    return (
        copied.where(f"{_MIX}.copies > 0")
        .withColumn("__mix_copy", F.explode(times))
        .select(*documents.columns)
    )
