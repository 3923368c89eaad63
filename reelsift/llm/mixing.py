"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order, up to ``MAX_PASSES`` times over. A queued document's virtual
finish time is the source's words up to and with it, divided by the source's weight. All queues are served in the
order of finish times until the budget is spent. A source that has been served ``MAX_PASSES`` times drops out and the
others go on, which is how what it can't use is shared out among them by weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.common import fresh, ordered_sums, task_partitions
from reelsift.session import durable

MAX_PASSES = 3
WEIGHT_CYCLE = (1, 2, 3)
#: Rows that a block of the ordered sums has on average.
BLOCK_ROWS = 20_000


def words_in(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[float, ...] = WEIGHT_CYCLE) -> DataFrame:
    """``source, weight``: the cycle's weights dealt out to the distinct sources by code point, null last."""
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())  # one row per source
    places = F.array(*[F.lit(float(w)) for w in cycle])
    rank = F.row_number().over(order) - 1
    return sources.select("source").distinct().select("source", F.get(places, rank % len(cycle)).alias("weight"))


def source_targets(sizes: DataFrame, weights: DataFrame, budget: float | None = None, max_passes: int = MAX_PASSES) -> DataFrame:
    """``source, weight, source_size, target``: the budget (default: all words) by weight, no source above ``max_passes`` times its size.

    The level ``v`` at which ``sum(min(max_passes * size, v * weight))`` is the budget solves it in one go: sources in
    the order in which they fill up, the level of each as if all before it were full and none after. Sources are few,
    one row each. A source without a weight gets nothing.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = totals.join(weights.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.where(F.col("weight") > 0)
    whole = Window.partitionBy(F.lit(0))
    order = whole.orderBy("_full_at", "source").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(whole).cast("double") if budget is None else F.lit(float(budget))
    rows = rows.withColumn("_cap", (F.col("source_size") * max_passes).cast("double"))
    rows = rows.withColumn("_full_at", F.col("_cap") / F.col("weight"))
    rows = rows.withColumn("_budget", total)
    rows = rows.withColumn("_filled", F.coalesce(F.sum("_cap").over(order), F.lit(0.0)))
    rows = rows.withColumn("_rest", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    rows = rows.withColumn("_level", (F.col("_budget") - F.col("_filled")) / F.col("_rest"))
    # The first source that doesn't fill up sets the level for itself and all after it.
    level = F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "source", "_level"))).over(whole)["_level"]
    target = F.least("_cap", F.coalesce(level * F.col("weight"), F.col("_cap")))
    return rows.withColumn("target", F.greatest(target, F.lit(0.0))).select("source", "weight", "source_size", "target")


def _entry_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text", "source")


def _plan(docs: DataFrame, weights: DataFrame | None, budget: float | None, seed: int, max_passes: int) -> DataFrame:
    """One row per queue entry: the rows that agree in ``doc_id``, ``source`` and text."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), _entry_hash(seed).alias("_shuffled"))
    # The texts are read once; what follows works on a few numbers per document.
    entries = durable(sized.groupBy("doc_id", "source", "_shuffled").agg(F.count("*").alias("_rows"), F.sum("size").alias("size")))
    weights = cyclic_weights(entries) if weights is None else weights
    targets = durable(source_targets(entries, weights, budget, max_passes))
    blocks = max(task_partitions(spark), -(-entries.count() // BLOCK_ROWS))
    queued = entries.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    queued = queued.withColumn("_block", F.pmod(F.shiftrightunsigned("_shuffled", 16), F.lit(blocks)))
    queued = durable(ordered_sums(queued, ["source"], "_block", ["_shuffled", "doc_id"], "size", "_ahead").drop("_block"))
    passes = F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1)))
    copies = queued.where("size > 0 AND weight > 0").select("*", passes.alias("_pass"))
    copies = copies.withColumn("finish", (F.col("_pass") * F.col("source_size") + F.col("_ahead") + F.col("size")) / F.col("weight"))
    # Fewer and fewer queues are served as virtual time goes on, so ranges of equal width never hold more than the first ones.
    end = F.max(F.col("target") / F.col("weight")).alias("_end")
    served = targets.agg(end, (F.lit(budget) if budget is not None else F.sum("source_size")).alias("_total")).first()
    end, total = float(served["_end"] or 1.0) or 1.0, served["_total"] or 0
    copies = copies.withColumn("_range", F.floor(F.col("finish") / F.lit(end) * blocks))
    served_before = ordered_sums(copies, [], "_range", ["finish", "source", "_shuffled", "doc_id"], "size", "_served")
    # A document is taken whole, if its middle lies within the budget.
    taken = served_before.where(F.col("_served") + F.col("size") / 2 <= F.lit(total))
    key = ("doc_id", "source", "_shuffled")
    counts = taken.groupBy(*key).agg(F.count("*").cast("int").alias("copies"))
    left, right = queued.alias("l"), counts.alias("r")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    return left.join(right, on, "left").select("l.*", F.coalesce("r.copies", F.lit(0)).alias("copies"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None, seed: int = 0, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, source``): ``doc_id, source, size, source_size, weight, target, copies, taken``.

    ``copies`` is how often the mix has the document, ``taken`` the words that makes. Null and empty texts have no
    words and are taken 0 times. Rows with the same ``doc_id`` are documents of their own; if they agree in source and
    text too, they are queued together and get the same number of copies. A null source is a source. The shuffle is a
    hash of the row and ``seed``, so reruns agree. An empty table gives an empty result.
    """
    plan = _plan(docs, weights, budget, seed, max_passes)
    plan = plan.withColumn("size", F.col("size") / F.col("_rows")).withColumn("size", F.col("size").cast("long"))
    return plan.select(
        "doc_id", "source", "size", "source_size", "weight", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_n"),
    ).drop("_n")


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None, seed: int = 0, max_passes: int = MAX_PASSES) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns kept, each as often as it is taken."""
    plan = _plan(docs, weights, budget, seed, max_passes).where("copies > 0")
    own, copy = fresh(docs, "_shuffled"), fresh(docs, "_copy")
    left, right = docs.withColumn(own, _entry_hash(seed)).alias("l"), plan.alias("r")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("doc_id", "source")] + [F.col(f"l.{own}") == F.col("r._shuffled")]
    repeated = left.join(right, on).select("l.*", F.explode(F.sequence(F.lit(1), F.col("r.copies"))).alias(copy))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
