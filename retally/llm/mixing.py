"""Mixing sources to target weights by entropy balancing.

A document's rate r (expected copies) is chosen to stay as close as possible
to one, in entropy, while every source's words reach its target and no rate
passes ``MOST`` copies.  With that bound the solution is the bounded
exponential tilt

    r = MOST / (1 + (MOST - 1) * exp(-lambda_source * size / mean_size)),

and each source's multiplier solves the convex dual
sum(r * size) = target.  The Newton steps (kept inside a bracket) run for all
sources at once: each step is one aggregation over the counts per (source,
size), joined with the multipliers, and one row of convergence figures is all
the driver sees.

Rounding into copies keeps the totals: within a source the cells (source,
size) are taken from the largest size down, each gets the whole number of
copies nearest to its rate plus what is still owed, and the rest of a cell's
rounding is owed to the next one.  So a source misses its target by about half
of its smallest documents unless whole copies cannot do better.  The copies of
a cell go to its documents in the order of a hash; cells of many documents are
ranked in salted parts of about ``PART`` rows, so a hot cell meets in no task.

Targets: sources in code point order, null last, take the weights in turn; a
target stops at ``MOST`` times its source's size and the excess is shared
again by weight.  Solved in one pass over the sources ordered by the share at
which they reach their bound (one row per source).

Defined results: null or blank text has size 0 and is taken 0 times its size;
repeated rows are separate documents; a source of size 0 has target 0; an
empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retally.llm.shared import WHITE, materialise

WEIGHTS = (5, 2, 1)
MOST = 3
PART = 256
STEPS = 80            # Newton steps at most; convergence needs about ten
EXACT = 1e-9


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text: places where a word starts."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.regexp_count(F.concat(F.lit(" "), spaced), F.lit(" [^ ]")).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources(source, source_size)`` with ``place`` (code point order, null last) and ``target``."""
    ranked = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    bounded = ranked.select("*", weight.alias("w"), (most * F.col("source_size")).cast("double").alias("bound"))
    order = Window.orderBy(F.col("bound") / F.col("w"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # If the sources before this one are at their bounds, the others share the remainder at this level per weight.
    level = ((F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    levels = bounded.withColumn("level", level).withColumn("full", F.col("bound") <= F.col("w") * F.col("level"))
    numbered = levels.withColumn("at", F.row_number().over(order))
    share = F.min(F.when(~F.col("full"), F.struct("at", "level"))).over(everything)["level"]
    return (numbered.withColumn("share", share)
            .select("source", "source_size", "place",
                    F.when(F.col("full"), F.col("bound")).otherwise(F.least("bound", F.col("w") * F.col("share"))).alias("target")))


def _rate(multiplier: Column, x: Column, most: int) -> Column:
    return F.lit(float(most)) / (1 + (most - 1) * F.exp(-multiplier * x))


def multipliers(cells: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """(place, multiplier): the dual solution of every source whose target lies inside (0, most * size)."""
    inner = sources.where((F.col("target") > 0) & (F.col("target") < most * F.col("source_size") * (1 - EXACT)))
    means = cells.groupBy("place").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = materialise(inner.join(means, "place").select(
        "place", "target", "mean", F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high")), "mix-state")
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("multiplier"), x, most)
        words = F.col("n") * F.col("size") * rate
        sums = cells.join(state, "place").groupBy("place").agg(
            F.sum(words).alias("got"), F.sum(words * x * (1 - rate / most)).alias("slope"))
        moved = state.join(sums, "place").withColumns({
            "low": F.when(F.col("got") <= F.col("target"), F.col("multiplier")).otherwise(F.col("low")),
            "high": F.when(F.col("got") >= F.col("target"), F.col("multiplier")).otherwise(F.col("high")),
            "newton": F.col("multiplier") - (F.col("got") - F.col("target")) / F.col("slope"),
            "miss": F.abs(F.col("got") / F.col("target") - 1)})
        inside = (F.col("newton") > F.coalesce("low", F.lit(float("-inf")))) & (F.col("newton") < F.coalesce("high", F.lit(float("inf")))) \
            & (F.abs(F.col("newton") - F.col("multiplier")) <= 4 * (1 + F.abs(F.col("multiplier"))))
        beside = (F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
                  .when(F.col("high").isNull(), 2 * F.abs(F.col("multiplier")) + 1)
                  .otherwise(-2 * F.abs(F.col("multiplier")) - 1))
        state = materialise(moved.select(
            "place", "target", "mean",
            F.when(F.col("miss") <= EXACT, F.col("multiplier")).when(inside, F.col("newton")).otherwise(beside).alias("multiplier"),
            "low", "high", "miss"), "mix-state")
        worst = state.agg(F.max("miss")).first()[0]
        state = state.drop("miss")
        if worst is None or worst <= EXACT:
            break
    else:
        raise ArithmeticError(f"a source is still {worst:.2e} off its target after {STEPS} Newton steps")
    # The order in which sums were added shows in the last digits only; without them reruns agree.
    return state.select("place", F.round("multiplier", 10).alias("multiplier"), "mean")


def _copies(cells: pd.DataFrame, most: int) -> pd.DataFrame:
    """Whole copies per cell of one source, largest sizes first, rounding owed to the next cell.

    One row per distinct size, so bounded by the number of sizes.
    """
    cells = cells.sort_values("size", ascending=False)
    owed, found = 0.0, []
    for size, n, rate in zip(cells["size"], cells["n"], cells["rate"]):
        if not size:
            found.append(int(n))
            continue
        want = n * rate * size + owed
        copies = int(min(max(round(want / size), 0), most * n))
        owed = want - copies * size
        found.append(copies)
    return cells.assign(copies=found)[["place", "size", "n", "copies"]]


def mix(docs: DataFrame, keep: list[str], text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The ``keep`` columns of every row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    sized = materialise(docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col(source_col).alias("source"),
                                    n_words(F.col(text_col)).alias("size")), "mix-rows")
    counted = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    sources = materialise(source_targets(
        counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most), "mix-sources")
    cells = materialise(counted.join(sources, counted["source"].eqNullSafe(sources["source"]))
                        .select("place", "size", "n"), "mix-placed")
    rates = (cells.join(multipliers(cells, sources, most), "place", "left").join(sources, "place")
             .select("place", "size", "n",
                     F.when(F.col("multiplier").isNotNull(), _rate(F.col("multiplier"), F.col("size") / F.col("mean"), most))
                     .when(F.col("target") > 0, F.lit(float(most))).otherwise(0.0).alias("rate")))
    copies = materialise(rates.groupBy("place").applyInPandas(
        lambda part: _copies(part, most), "place int, size long, n long, copies long").join(sources, "place")
        .select("source", "size", "n", "copies", "source_size", "target", "place"), "mix-copies")

    # Hot (source, size) keys: both sides are plain tables, so Spark can split a skewed partition of the rows.
    salted = materialise(
        sized.alias("r").join(copies.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.size") == F.col("c.size")))
        .select(*[f"k_{c}" for c in keep], "r.size", "place", "n", "copies", "source_size", "target",
                F.xxhash64(*[f"k_{c}" for c in keep]).alias("hash"))
        .withColumn("part", F.pmod(F.col("hash"), F.ceil(F.col("n") / PART).cast("long")).cast("long")), "mix-salted")
    # The cell's remaining copies, dealt to its parts in proportion to their rows.
    cell = Window.partitionBy("place", "size")
    parts = (salted.where("copies % n > 0").groupBy("place", "size", "part")
             .agg(F.count("*").alias("rows"), F.first("n").alias("n"), F.first("copies").alias("copies"))
             .withColumn("upto", F.sum("rows").over(cell.orderBy("part"))))
    quota = parts.select("place", "size", "part", F.expr(
        "(copies % n) * upto div n - (copies % n) * (upto - rows) div n").alias("extra")).where("extra > 0")
    order = Window.partitionBy("place", "size", "part").orderBy("hash", *[f"k_{c}" for c in keep])
    chosen = (salted.withColumn("turn", F.row_number().over(order))
              .join(materialise(quota, "mix-quota"), ["place", "size", "part"], "left"))
    copied = F.expr("copies div n") + F.when(F.col("turn") <= F.coalesce("extra", F.lit(0)), 1).otherwise(0)
    return (chosen.withColumn("copies", copied.cast("long"))
            .select(*[F.col(f"k_{c}").alias(c) for c in keep], "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))
