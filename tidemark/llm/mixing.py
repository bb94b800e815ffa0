"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of a budget. A source may be repeated at
most ``max_epochs`` times, so shares above that stop there and the excess goes to the
others by weight, until none is above. With sources in order of (cap / weight) the
stopped ones are a prefix, so the fixed point needs one running sum and no loop.

A document is then taken ``floor(target / size of source)`` times, and once more if its
seeded draw does not exceed its source's threshold: the last draw up to which the extra
words still fit. Of rows that share that draw (equal id and text) as many are taken as fit.
One more document, the one whose size comes nearest to the gap then left, closes most of
it. Draws are ordered in range partitions with
carried sums: a source that holds most rows is spread over many tasks, and only thin
rows (source, draw, size) are moved, never texts.

Defined cases: a null text has size 0; a null source is a source of its own, last in
order; rows that repeat are documents of their own that share one draw, and which of them
are taken goes by a hash of all their columns, so only rows equal throughout are
interchangeable; a source without words has target 0 and is taken once by nobody; an empty
table gives no rows; input columns named ``size``, ``source_size``, ``target`` or ``copies``
are no part of the plan's rows (``mix``), and all are kept in the mix itself
(``mixed_documents``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import Scratch

WEIGHTS = (5, 2, 1)
BUDGET = (3, 2)  # 150 % of all sizes, as a fraction
MAX_EPOCHS = 2
SEED = "mix-1"


def draw_of(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """The document's place in its source's drawing order; the same in every run."""
    parts = [F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def running_sums(df: DataFrame, order: Sequence[Column], values: dict[str, Column], scratch: Scratch, label: str) -> DataFrame:
    """``df`` with the sum of each value over all rows up to this one, in a global order.

    One range shuffle for all values; ranges are written down, as their bounds come from
    a sample, and a range carries the totals of those before it.
    """
    placed = df.select("*", *[v.alias(n) for n, v in values.items()]).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = scratch.put(placed.withColumn("_at", F.monotonically_increasing_id()), f"{label}-ordered").withColumn(
        "_range", F.shiftright("_at", 33))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = ordered.groupBy("_range").agg(*[F.sum(n).alias(f"_t{n}") for n in values]).select(
        "_range", *[F.coalesce(F.sum(f"_t{n}").over(earlier), F.lit(0)).alias(f"_t{n}") for n in values])
    inside = W.partitionBy("_range").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    summed = ordered.select(*df.columns, "_range", *[F.sum(n).over(inside).alias(n) for n in values])
    done = summed.join(F.broadcast(carried), "_range").select(  # one row per shuffle partition
        *df.columns, *[(F.col(n) + F.col(f"_t{n}")).alias(n) for n in values])
    return scratch.put(done, label)


def source_targets(
    sizes: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """(source, source_size, source_end, target) from rows (source, size); source_end is
    the running sum of sizes in the sources' order.

    ``weights`` go to the sources in code-point order, null last, and repeat.
    """
    by_name = [F.col("source").isNull(), F.col("source")]
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = running_sums(per_source, by_name, {"_place": F.lit(1), "source_end": F.col("source_size")}, scratch, "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    sources = placed.select(
        "source", "source_size", "source_end", weight.cast("bigint").alias("_w"), (F.col("source_size") * max_epochs).alias("_cap")
    )
    filled = running_sums(
        sources, [F.col("_cap") / F.col("_w"), *by_name], {"_caps": F.col("_cap"), "_ws": F.col("_w")}, scratch, "filled"
    )
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("_w").alias("weight")).first()
    words, weight = (whole["size"] or 0) * budget[0] / budget[1], whole["weight"] or 0
    # level offered to a source once all before it have stopped at their caps
    level = (F.lit(words) - (F.col("_caps") - F.col("_cap"))) / (F.lit(weight) - (F.col("_ws") - F.col("_w")))
    # levels rise until the first source below its cap, whose level holds for the rest, and fall after it
    final = filled.filter(F.col("_cap") > level * F.col("_w")).agg(F.max(level)).first()[0]
    cap = F.col("_cap").cast("double")
    share = cap if final is None else F.least(cap, F.lit(final) * F.col("_w"))
    return filled.select("source", "source_size", "source_end", share.alias("target"))


def repetitions(sizes: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """Per source: ``whole`` copies of each document, ``below``, the draw before which each
    document is taken once more, and ``edges``: draws of which only some rows are taken
    once more, with their number. ``sizes`` has (source, size, draw)."""
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.withColumn("whole", F.floor(epochs).cast("bigint"))
    plan = scratch.put(plan.withColumn("_missing", F.col("target") - F.col("whole") * F.col("source_size")), "whole")
    order = [F.col("source").isNull(), F.col("source"), F.col("draw"), F.col("size")]
    thin = running_sums(sizes.select("source", "size", "draw"), order, {"_upto": F.col("size")}, scratch, "drawn")
    starts = plan.filter("_missing > 0").select(
        F.col("source").alias("_source"), (F.col("source_end") - F.col("source_size")).alias("_start"), "_missing")
    placed = thin.join(starts, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_mine", F.col("_upto") - F.col("_start"))
    # rows that fit whole, in order of their draws; then the one row that best fills the gap left
    last = scratch.put(placed.filter("_mine <= _missing").groupBy("source").agg(
        F.max("draw").alias("_last"), F.max("_mine").alias("_filled")), "last").withColumnRenamed("source", "_s")
    found = placed.join(last, F.col("source").eqNullSafe(F.col("_s")), "left")
    off = F.abs(F.col("size") - F.col("_gap"))
    edges = (
        found.withColumn("_gap", F.col("_missing") - F.coalesce("_filled", F.lit(0))).groupBy("source").agg(
            F.first("_last").alias("below"),
            F.count_if((F.col("draw") == F.col("_last")) & (F.col("_mine") <= F.col("_missing"))).alias("_fit"),
            F.min(F.when((F.col("_mine") > F.col("_missing")) & (off < F.col("_gap")), F.struct(off.alias("off"), F.col("draw")))).alias("_fill"),
        )
    ).select(
        F.col("source").alias("_f"), "below",
        F.filter(F.array(F.struct(F.col("below").alias("draw"), F.col("_fit").alias("n")), F.struct(F.col("_fill.draw").alias("draw"), F.lit(1).cast("bigint").alias("n"))),
                 lambda e: e["draw"].isNotNull()).alias("edges"),
    )
    return plan.join(edges, F.col("source").eqNullSafe(F.col("_f")), "left").select("source", "source_size", "target", "whole", "below", "edges")


def with_copies(docs: DataFrame, plan: DataFrame, draw: Column, scratch: Scratch) -> DataFrame:
    """``docs`` with source_size, target and copies. ``plan`` has a row per source.

    The few rows at a source's edges, or many where rows repeat, are written down and
    numbered by running sums, in order of a hash of all columns."""
    named = plan.select(F.col("source").alias("_source"), F.struct("source_size", "target", "whole", "below", "edges").alias("_plan"))
    kept = [c for c in docs.columns if c not in ("source_size", "target", "copies")]
    found = docs.select(F.struct(*kept).alias("_doc"), "source", draw.alias("_draw")).join(
        named, F.col("source").eqNullSafe(F.col("_source")), "left")
    taken = F.coalesce(F.aggregate("_plan.edges", F.lit(0).cast("bigint"), lambda a, e: a + F.when(e["draw"] == F.col("_draw"), e["n"]).otherwise(0)), F.lit(0))
    found = found.withColumn("_taken", taken)
    edge = scratch.put(found.filter("_taken > 0").select("*", F.xxhash64(F.to_json("_doc")).alias("_hash"), F.monotonically_increasing_id().alias("_nr")), "edge")
    order = [F.col("source").isNull(), F.col("source"), F.col("_draw"), F.col("_hash"), F.col("_nr")]
    counted = running_sums(edge.select("source", "_draw", "_hash", "_nr", "_taken"), order, {"_upto": F.lit(1).cast("bigint")}, scratch, "edges")
    before = counted.groupBy(F.col("source").alias("_s"), F.col("_draw").alias("_d")).agg((F.min("_upto") - 1).alias("_before"))
    numbered = counted.join(before, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_draw") == F.col("_d")))
    more = numbered.filter("_upto - _before <= _taken").select(F.col("_nr").alias("_more"))
    at_edge = edge.join(more, F.col("_nr") == F.col("_more"), "left").withColumn("_extra", F.col("_more").isNotNull())
    inside = found.filter("_taken = 0").withColumn("_extra", F.coalesce(F.col("_draw") < F.col("_plan.below"), F.lit(False)))
    columns = ["_doc", "_plan", "_extra"]
    return inside.select(*columns).unionByName(at_edge.select(*columns)).select(
        "_doc.*",
        F.col("_plan.source_size").alias("source_size"),
        F.col("_plan.target").alias("target"),
        (F.coalesce(F.col("_plan.whole"), F.lit(0)) + F.col("_extra").cast("bigint")).alias("copies"),
    )


def mix(docs: DataFrame, size: Column, seed: str = SEED, **targets: object) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row of ``docs``.

    ``size`` is worked out once per text and written down; all sums and draws are taken
    from there. ``targets`` go to ``source_targets``.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.put(
        docs.select("doc_id", "source", size.alias("size"), draw_of(F.col("doc_id"), F.col("text"), seed).alias("draw")),
        "sizes",
    )
    plan = scratch.put(repetitions(sizes, source_targets(sizes, scratch, **targets), scratch), "plan")
    return with_copies(sizes, plan, F.col("draw"), scratch).drop("draw")


def mixed_documents(docs: DataFrame, size: Column, seed: str = SEED, **targets: object) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its source's plan takes it."""
    scratch = Scratch(docs.sparkSession, "mix")
    draw = draw_of(F.col("doc_id"), F.col("text"), seed)
    sizes = scratch.put(docs.select("source", size.alias("size"), draw.alias("draw")), "sizes")
    plan = scratch.put(repetitions(sizes, source_targets(sizes, scratch, **targets), scratch), "plan")
    row = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text")  # any other column may clash
    taken = with_copies(row, plan, draw, scratch).filter("copies > 0")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
