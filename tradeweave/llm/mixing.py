"""Mixing sources to target weights by entropy balancing.

Every document gets a rate r, the copies the mix would take of it if copies could be broken. Rates are the ones
closest to 1 in relative entropy, within 0 <= r <= limit, whose words add up to each source's target:

    minimise  sum_i  r_i log r_i - r_i      subject to  sum_{i in source} size_i r_i = target(source).

The dual has one multiplier per source and is convex; its solution tilts a source's documents exponentially by size,
r_i = min(limit, exp(multiplier * size_i / mean size)). Newton steps on the dual run as Spark aggregations over the
histogram (source, size, documents): all documents of one size share one rate, so a hot source is as many rows as it
has sizes. A step that would leave the bracket of the root halves or doubles instead.

Rates are rounded into whole copies, sizes ascending: the broken parts are summed along a source and a document gets
one copy more wherever the sum passes a half. What the source then still misses is made up by one document of about
that size. Sums are kept in whole numbers, so reruns agree bit by bit.

Only DataFrame functions run here. Results for odd input: a null, empty or blank text has size 0 and is taken once;
a null source is a source of its own, last in order; repeated rows are separate documents that may get different
numbers of copies; an empty table gives no rows; input columns with the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.llm.text import apart, together, word_count
from tradeweave.session import stage

WEIGHTS = (5, 2, 1)  # by the source's place in code point order, repeating
LIMIT = 3  # most copies of a document, and most times a source's size that its target may be
CELL_ROWS = 1000  # a source's documents of one size are ranked together up to about this many
TOLERANCE = 1e-9  # of the target
MAX_STEPS = 80
_PARTS = 1 << 20  # a broken copy counts in these parts
_WORD_PARTS = 256  # a word of a source's sum counts in these parts


def prefix_sums(df: DataFrame, order: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add `<m>_before` (sum over earlier rows) and `<m>_all`, without a task that sees all rows.

    A range-partitioned copy is written; its few partition totals give offsets to windows inside partitions.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}")
                                       for m in measures],
                            *[F.sum(f"_t_{m}").over(Window.partitionBy(F.lit(0))).alias(f"{m}_all") for m in measures])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(offsets, "_part").select(
        *df.columns, *[f"{m}_all" for m in measures],
        *[(F.col(f"_o_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_before") for m in measures])


def source_key(source: Column) -> Column:
    """A string that is never null and sorts as the sources do: by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(`_key`, `_total`, ...) gains `_target`: weights share all words, no target above limit * total.

    Excess goes to the other sources by weight until none is above. A source reaches its limit once the common level
    per weight passes its ratio limit * total / weight; one running sum in the order of ratios finds that level.
    """
    placed = prefix_sums(sources.withColumn("_one", F.lit(1).cast("long")), ["_key"], ["_one"])
    weighed = placed.withColumn("_weight", F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("_one_before") % len(weights) + 1).cast("int")))
    weighed = stage(weighed.withColumn("_ratio", F.lit(float(limit)) * F.col("_total") / F.col("_weight")).drop(
        "_one", "_one_all", "_one_before"))
    ratios = weighed.groupBy("_ratio").agg(F.sum("_total").alias("_t"), F.sum("_weight").alias("_w"))
    levels = prefix_sums(ratios, ["_ratio"], ["_t", "_w"])
    # with all smaller ratios at their limit, the others share the rest; the first level that fits is the one
    level = (F.col("_t_all") - F.lit(limit) * F.col("_t_before")) / (F.col("_w_all") - F.col("_w_before"))
    found = levels.filter(level <= F.col("_ratio")).agg(F.min_by(level, F.col("_ratio"))).first()[0]
    return weighed.withColumn("_target", F.least(
        F.lit(float(limit)) * F.col("_total"), F.lit(float(found or 0.0)) * F.col("_weight")))


def solve_multipliers(histogram: DataFrame, sources: DataFrame, limit: int = LIMIT) -> DataFrame:
    """`sources` (_key, _total, _docs, _target) with `_multiplier`; null where every rate is at the limit or 1.

    One aggregation over the histogram per Newton step; the state of the sources is a table like any other.
    """
    solvable = (F.col("_total") > 0) & (F.col("_target") < F.lit(limit * (1 - 1e-12)) * F.col("_total"))
    cells = stage(histogram.join(sources.filter(solvable).select(
        "_key", (F.col("_total") / F.col("_docs")).alias("_mean")), "_key").select(
        "_key", (F.col("_size") / F.col("_mean")).alias("_x"), (F.col("_n") * F.col("_size")).alias("_words")))
    none = F.lit(None).cast("double")
    state = sources.filter(solvable).select("_key", "_target", F.lit(0.0).alias("_multiplier"), none.alias("_low"),
                                            none.alias("_high"))
    rate = F.exp(F.col("_multiplier") * F.col("_x"))
    inside = rate < limit

    def total(value: Column) -> Column:
        return F.sum(F.round(value * _WORD_PARTS).cast("long")) / F.lit(float(_WORD_PARTS))

    for _ in range(MAX_STEPS):
        summed = cells.join(state, "_key").groupBy("_key").agg(
            *[F.first(c).alias(c) for c in ("_target", "_multiplier", "_low", "_high")],
            total(F.col("_words") * F.least(rate, F.lit(float(limit)))).alias("_sum"),
            total(F.when(inside, F.col("_words") * F.col("_x") * rate).otherwise(0.0)).alias("_slope"))
        at, above = F.col("_multiplier"), F.col("_sum") > F.col("_target")
        low, high = F.when(above, F.col("_low")).otherwise(at), F.when(above, at).otherwise(F.col("_high"))
        newton = at - F.log(F.col("_sum") / F.col("_target")) * F.try_divide(F.col("_sum"), F.col("_slope"))
        fits = newton.isNotNull() & ~F.isnan(newton) & (low.isNull() | (newton > low)) & (
            high.isNull() | (newton < high)) & (F.abs(newton - at) <= F.lit(2.0) + 4 * F.abs(at))
        halved = F.when(low.isNull(), 2 * at - 1).when(high.isNull(), 2 * at + 1).otherwise((low + high) / 2)
        gap = F.abs(F.col("_sum") - F.col("_target"))
        done = gap <= F.greatest(F.lit(0.01), F.lit(TOLERANCE) * F.col("_target"))
        state = stage(summed.select(
            "_key", "_target", F.when(done, at).when(fits, newton).otherwise(halved).alias("_multiplier"),
            low.alias("_low"), high.alias("_high"), done.alias("_done")))
        if state.filter(~F.col("_done")).isEmpty():
            break
        state = state.drop("_done")
    return sources.join(state.select("_key", "_multiplier"), "_key", "left")


def _rounded(placed: DataFrame) -> DataFrame:
    """Cells with `_extra`, how many of their documents get one copy more: broken parts summed along the source."""
    starts = placed.groupBy("_key").agg(F.min("_parts_before").alias("_start"))
    before = F.col("_parts_before") - F.col("_start") + _PARTS // 2
    return placed.join(starts, "_key").withColumn(
        "_extra", F.floor((before + F.col("_parts")) / _PARTS) - F.floor(before / _PARTS))


def _nearest(cells: DataFrame, limit: int) -> DataFrame:
    """Where it brings a source's words nearer to its target, one document of a fitting size goes one copy up or down."""
    taken = F.col("_size") * (F.floor("_rate") * F.col("_n") + F.col("_extra"))
    cells = stage(cells)
    miss = cells.groupBy("_key").agg((F.first("_target") - F.sum(taken)).alias("_miss"))
    step = F.when(F.col("_miss") > 0, 1).otherwise(-1)
    room = F.when(F.col("_miss") > 0, (F.col("_extra") < F.col("_n")) & (F.col("_rate") < limit)).otherwise(
        F.col("_extra") > 0)
    left = F.abs(F.abs(F.col("_miss")) - F.col("_size"))
    chosen = cells.join(miss, "_key").filter(room & (left < F.abs("_miss"))).groupBy("_key").agg(
        F.min(F.struct(left.alias("left"), F.col("_size").alias("size"), F.col("_cell").alias("cell"),
                       step.alias("step"))).alias("_best"))
    hit = (F.col("_best.size") == F.col("_size")) & (F.col("_best.cell") == F.col("_cell"))
    return cells.join(chosen, "_key", "left").select(
        "_key", "_size", "_cell", "_total", "_target", "_rate",
        (F.col("_extra") + F.when(hit, F.col("_best.step")).otherwise(0)).alias("_extra"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """`docs` with `size`, `source_size`, `target` (of its source), `rate` and `copies` (whole, 0 to `limit`).

    Texts are read twice and move once, by (source, size, part), where a part holds some thousand rows at most.
    """
    inner, at = apart(docs)
    parts = max(1, -(-docs.count() // CELL_ROWS))
    spot = F.xxhash64(F.col(at[doc_id]))
    sized = inner.withColumn("_key", source_key(F.col(at[source]))).withColumn(
        "_size", word_count(F.col(at[text]))).withColumn("_cell", F.pmod(spot, F.lit(parts)))
    cells = stage(sized.groupBy("_key", "_size", "_cell").agg(F.count(F.lit(1)).alias("_n")))
    histogram = cells.groupBy("_key", "_size").agg(F.sum("_n").alias("_n"))
    sources = stage(source_targets(
        histogram.groupBy("_key").agg(F.sum(F.col("_n") * F.col("_size")).alias("_total"), F.sum("_n").alias("_docs")),
        weights, limit))
    solved = stage(solve_multipliers(histogram, sources, limit))
    tilt = F.exp(F.col("_multiplier") * F.col("_size") * F.col("_docs") / F.col("_total"))
    rate = F.when(F.col("_size") == 0, 1.0).when(F.col("_multiplier").isNull(), float(limit)).otherwise(
        F.least(tilt, F.lit(float(limit))))
    rated = cells.join(solved, "_key").select(
        "_key", "_size", "_cell", "_n", "_total", "_target", rate.alias("_rate")).withColumn(
        "_part_copy", F.round((F.col("_rate") - F.floor("_rate")) * _PARTS).cast("long")).withColumn(
        "_parts", F.col("_part_copy") * F.col("_n"))
    extras = _nearest(_rounded(prefix_sums(rated, ["_key", "_size", "_cell"], ["_parts"])), limit)
    rank = F.row_number().over(Window.partitionBy("_key", "_size", "_cell").orderBy("_spot", at[doc_id]))
    ranked = sized.withColumn("_spot", spot).withColumn("_rank", rank).join(extras, ["_key", "_size", "_cell"])
    copies = F.floor("_rate") + (F.col("_rank") <= F.col("_extra")).cast("int")
    return together(ranked, docs.columns, [
        ("size", F.col("_size")), ("source_size", F.col("_total")), ("target", F.col("_target")),
        ("rate", F.col("_rate")), ("copies", copies.cast("int"))])
