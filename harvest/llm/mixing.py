"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

The document rates are those nearest to 1, in relative entropy and between 0 and `most`, whose words add up to the target of
each source. Their dual is convex with one variable for each source, and the rate of a document is the exponential tilt
exp(lambda * size / mean size), stopped at `most`. Newton steps on the logarithm of the words taken, kept in a bracket, solve
all sources at once; each step is one aggregation over the counts of (source, size), on which the rates depend.

Rates become whole copies by systematic rounding along the sizes of a source, from long to short: neighbours have like sizes,
so the errors cancel and the words of a source miss the target by half of its longest document at most. Three short rounds
then give or take one copy of the document that best closes the gap of its source.

A null text has size 0; a null source is a source of its own, the last in order. Documents without words take nothing.
Repeated rows are documents of their own, numbered among the rows of the same doc_id, source and text: a doc_id, or no
doc_id, that many texts share is spread by their hashes, rows equal in all three meet in one task. If no document has words, all targets are 0. An empty
table gives an empty table; columns of any other name are left alone. One row for each source is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvest.llm.common import WORD, free_names, parts_for, quoted, uniform, with_running
from harvest.sources.scratch import written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
ROUNDS = 40
#: Relative gap of the words of a source at which the Newton steps end.
CLOSE = 1e-7
CLOSING_ROUNDS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(docs: DataFrame, size: str = "__size", mark: str = "__mark", nth: str = "__nth") -> DataFrame:
    """`docs` with its words, a hash of source and text, and the place of a row among those of its doc_id and hash.

    All three depend on the row alone, so a rerun copies the same texts. Texts of one hash share a numbering, which loses none.
    """
    window = Window.partitionBy("doc_id", mark).orderBy("source", size)
    sized = docs.withColumn(size, words(F.col("text"))).withColumn(mark, F.xxhash64("source", "text"))
    return sized.withColumn(nth, F.row_number().over(window))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, n, target). `weights` repeat along the sources in code point order, null last; they share the
    words of all sources, and what passes `most` times the words of a source is shared again among the others."""
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("n").alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    ranked = each.withColumn("weight", weight).withColumn("cap", cap).withColumn("full_at", cap / F.col("weight"))
    # The level at which source k would be filled, if all that fill up before it are full.
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = ranked.withColumn("level", left / F.sum("weight").over(rest)).withColumn("place", F.row_number().over(order))
    open_ = F.when(F.col("full_at") > F.col("level"), F.struct("place", "level"))
    final = level.withColumn("final", F.min(open_).over(every)["level"])
    target = F.when(F.col("final").isNull() | (F.col("full_at") <= F.col("final")), F.col("cap")).otherwise(F.col("weight") * F.col("final"))
    return final.select("source", "source_size", "n", target.alias("target"))


def rates(sizes: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, size, n, rate): `sizes` with the rate of a document of this size."""
    mean = F.greatest(F.col("source_size") / F.col("n"), F.lit(1e-9))
    fixed = F.when(F.col("target") >= F.col("source_size") * F.lit(most * (1 - 1e-9)), F.lit(float(most)))
    start = targets.select(
        F.col("source").alias("of"), "target", mean.alias("mean"), fixed.alias("fixed"), F.lit(0.0).alias("dual"), F.lit(-1e9).alias("low"), F.lit(1e9).alias("high")
    )
    state = written(start, "mixing-dual")
    tilt = F.exp(F.least(F.col("dual") * F.col("size") / F.col("mean"), F.lit(60.0)))
    rate = F.coalesce("fixed", F.least(tilt, F.lit(float(most))))
    match = F.col("source").eqNullSafe(F.col("of"))
    for _ in range(ROUNDS):
        joined = sizes.join(state, match)
        mass = F.col("n") * F.col("size")
        taken = joined.groupBy("of").agg(
            F.sum(mass * rate).alias("taken"),
            F.sum(F.when(tilt < most, mass * tilt * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
        )
        got = state.join(taken.withColumnRenamed("of", "__of"), F.col("of").eqNullSafe(F.col("__of"))).drop("__of")
        gap = F.col("taken") - F.col("target")
        done = F.col("fixed").isNotNull() | (F.abs(gap) <= CLOSE * F.greatest(F.col("target"), F.lit(1.0)))
        low, high = F.when(gap < 0, F.col("dual")).otherwise(F.col("low")), F.when(gap > 0, F.col("dual")).otherwise(F.col("high"))
        moved = got.select("*", low.alias("low_"), high.alias("high_"), done.alias("done"))
        step = (F.log(F.greatest("target", F.lit(1e-12))) - F.log(F.greatest("taken", F.lit(1e-12)))) * F.col("taken") / F.col("slope")
        newton = F.col("dual") + F.when(F.col("slope") > 0, F.greatest(F.least(step, F.lit(64.0)), F.lit(-64.0)))
        inside = (newton > F.col("low_")) & (newton < F.col("high_"))
        middle = F.when(F.col("high_") >= 1e9, F.col("dual") + 16 + F.abs("dual")).when(F.col("low_") <= -1e9, F.col("dual") - 16 - F.abs("dual")).otherwise((F.col("low_") + F.col("high_")) / 2)
        dual = F.when(F.col("done"), F.col("dual")).when(inside, newton).otherwise(middle)
        state = written(moved.select("of", "target", "mean", "fixed", dual.alias("dual"), F.col("low_").alias("low"), F.col("high_").alias("high"), "done"), "mixing-dual")
        open_left = state.where("not done").count()
        state = state.drop("done")
        if not open_left:
            break
    return sizes.join(state, match).select("source", "size", "n", rate.alias("rate"))


def copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, __mark, __nth, source, size, source_size, target, rate and copies (0 to `most`) of every row of `docs` (doc_id, text, source)."""
    rows = numbered(docs.select("doc_id", "text", "source")).select("doc_id", "__mark", "__nth", "source", F.col("__size").alias("size"))
    rows = written(rows, "mixing-sizes")
    sizes = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-counts")
    targets = written(source_targets(sizes.select("source", (F.col("size") * F.col("n")).alias("size"), "n"), weights, most), "mixing-targets")
    rated = written(rates(sizes, targets, most), "mixing-rates")
    # Rates before a class of equal sizes, long ones first; sizes of one source are spread over parts.
    stretch = rated.withColumn("__part", -F.floor(F.log2(F.col("size") + 1) * 8)).withColumn("__all", F.col("n") * F.col("rate"))
    begun = with_running(stretch, {"begun": F.col("__all")}, ["source"], "__part", [F.col("size").desc()])
    begun = begun.select(F.col("source").alias("__source"), F.col("size").alias("__size"), "rate", "begun")
    parts = parts_for(rows.count(), 4000)
    row = ["doc_id", "__mark", "__nth"]
    at = uniform(*map(F.col, row))
    ranked = with_running(rows.withColumn("__at", at).withColumn("__part", F.floor(at * parts)), {"rank": F.lit(1)}, ["source", "size"], "__part", [F.col("__at"), *map(F.col, row)])
    joined = ranked.join(begun, F.col("source").eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size")))
    upto = lambda k: F.floor(F.col("begun") + k * F.col("rate") + 0.5)
    whole = F.least(F.greatest(upto(F.col("rank") + 1) - upto(F.col("rank")), F.lit(0)), F.lit(most)).cast("int")
    first = written(joined.select(*row, "source", "size", "rate", whole.alias("copies")), "mixing-copies")
    changes = first.limit(0).select(F.col("doc_id").alias("__doc"), F.col("__mark").alias("__of"), F.col("__nth").alias("__row"), F.lit(0).alias("__change"))
    goals = targets.select(F.col("source").alias("of"), "target")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__mark") == F.col("__of")) & (F.col("__nth") == F.col("__row"))

    def now() -> DataFrame:
        change = changes.groupBy("__doc", "__of", "__row").agg(F.sum("__change").cast("int").alias("__change"))
        return first.join(change, same, "left").withColumn("copies", F.col("copies") + F.coalesce("__change", F.lit(0))).drop("__doc", "__of", "__row", "__change")

    for _ in range(CLOSING_ROUNDS):
        state = now()
        gaps = state.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
        gaps = goals.join(gaps, F.col("of").eqNullSafe(F.col("source"))).select("of", (F.col("target") - F.col("taken")).alias("gap"))
        able = F.when(F.col("gap") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
        closes = (F.col("size") > 0) & (F.col("size") < 2 * F.abs("gap")) & able
        near = F.abs(F.col("size") - F.abs("gap"))
        best = state.join(gaps, F.col("source").eqNullSafe(F.col("of"))).where(closes)
        best = best.groupBy("of").agg(F.min(F.struct(near, uniform(*map(F.col, row)), *row, F.signum("gap").cast("int").alias("sign"))).alias("b"))
        changes = written(changes.union(best.select("b.doc_id", "b.__mark", "b.__nth", "b.sign")), "mixing-changes")
    out = now().join(targets.select(F.col("source").alias("__source"), "source_size", "target"), F.col("source").eqNullSafe(F.col("__source")))
    return out.drop("__source")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with the columns of `docs`."""
    size, mark, nth, of, by, row, times, copy = free_names(docs, 8)
    plan = copies(docs, weights, most).where("copies > 0")
    plan = plan.select(F.col("doc_id").alias(of), F.col("__mark").alias(by), F.col("__nth").alias(row), F.col("copies").alias(times))
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(mark) == F.col(by)) & (F.col(nth) == F.col(row))
    joined = numbered(docs, size, mark, nth).join(plan, same)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*(quoted(c) for c in docs.columns))
