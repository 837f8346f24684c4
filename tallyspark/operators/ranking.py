"""Sorts, arg-min choices and the early-stopping rule.

``early_stop`` needs, for every round, the best (lowest loss, earliest round)
seen so far in its run -- a prefix minimum. It is computed in two levels so no
run is ever processed by one task: a window inside fixed-size round chunks,
the same over chunk minima (twice; each level is ``chunk`` times smaller), then a
``min`` aggregate finds the first round that waited ``patience`` rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import join_same
from tallyspark.session import materialize


def sort_importance(imp: DataFrame, value: str = "importance", feature: str = "feature") -> DataFrame:
    """O1: ascending by importance (feature name breaks ties)."""
    return imp.orderBy(F.col(value).asc(), F.col(feature).asc())


def argmin_by_group(trials: DataFrame, by: Sequence[str], loss: str, trial_id: str,
                    carry: Sequence[str]) -> DataFrame:
    """Per group the trial with the lowest loss (ties: lowest trial id),
    with its ``carry`` columns; a partial-aggregating ``min_by``."""
    payload = F.struct(F.col(trial_id).alias(trial_id), F.col(loss).alias(loss),
                       *[F.col(c).alias(c) for c in carry])
    order = F.struct(F.col(loss), F.col(trial_id))
    ok = trials.filter(F.col(loss).isNotNull() & ~F.isnan(loss))
    best = ok.groupBy(*by).agg(F.min_by(payload, order).alias("_best"))
    return best.select(*by, *[F.col(f"_best.{c}").alias(c) for c in [trial_id, loss, *carry]])


def early_stop(losses: DataFrame, run: str = "run_id", rnd: str = "round", loss: str = "loss",
               patience: int = 40, chunk: int = 4096) -> DataFrame:
    """Per run ``best_round``, ``best_loss`` (at the stop, or overall when
    training never stops), ``stop_round`` (first round with
    ``round - best_round >= patience``, NULL if none) and ``n_rounds``."""
    best_t = F.struct(F.col(loss).alias("l"), F.col(rnd).alias("r"))
    base = (losses.select(F.col(run).alias(run), F.col(rnd).alias(rnd), F.col(loss).alias(loss))
                  .filter(F.col(loss).isNotNull() & ~F.isnan(loss))
                  .withColumn("_chunk", F.floor(F.col(rnd) / chunk)))
    w_in = Window.partitionBy(run, "_chunk").orderBy(rnd).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumn("_lbest", F.min(best_t).over(w_in))
    # Chunk minima, then minima of chunks of chunks, and so on: no window ranks a whole run.
    prev = _earlier_minima(base.groupBy(run, "_chunk").agg(F.min(best_t).alias("_cbest")), run, chunk)
    pref = (join_same(local, prev, [run, "_chunk"])
                 .withColumn("_best", F.least(F.col("_prev"), F.col("_lbest"))))
    waited = F.col(rnd) - F.col("_best.r") >= patience
    stops = (pref.filter(waited).groupBy(run)
                 .agg(F.min_by(F.struct(F.col(rnd).alias("stop"), F.col("_best").alias("b")), F.col(rnd))
                      .alias("_s")))
    totals = base.groupBy(run).agg(F.min(best_t).alias("_all"), F.count(F.lit(1)).alias("n_rounds"))
    out = join_same(totals, stops, [run], "left")
    return out.select(
        run,
        F.coalesce(F.col("_s.b.r"), F.col("_all.r")).alias("best_round"),
        F.coalesce(F.col("_s.b.l"), F.col("_all.l")).alias("best_loss"),
        F.col("_s.stop").alias("stop_round"),
        "n_rounds")


def _earlier_minima(chunks: DataFrame, run: str, chunk: int, levels: int = 2) -> DataFrame:
    """(run, _chunk, _prev): the least ``_cbest`` of the run's earlier chunks.

    A window inside blocks of ``chunk`` chunks, and the earlier blocks' minima by the same step.
    """
    if levels == 0:
        w = Window.partitionBy(run).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        return chunks.select(run, "_chunk", F.min("_cbest").over(w).alias("_prev"))
    held = materialize(chunks.withColumn("_block", F.floor(F.col("_chunk") / chunk)), "chunks")
    above = _earlier_minima(held.groupBy(run, F.col("_block").alias("_chunk")).agg(F.min("_cbest").alias("_cbest")), run, chunk, levels - 1)
    w = Window.partitionBy(run, "_block").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = held.select(run, "_block", "_chunk", F.min("_cbest").over(w).alias("_near"))
    joined = join_same(inside, above.select(run, F.col("_chunk").alias("_block"), F.col("_prev").alias("_far")), [run, "_block"])
    return joined.select(run, "_chunk", F.least("_far", "_near").alias("_prev"))


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence, out: str = "position",
                n_parts: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY by ORDER BY order)`` without placing a
    whole group in one task.

    Rows are range-partitioned on (by, order) -- a big group spans many
    partitions -- numbered inside each partition by a window; a small
    table of row counts per (partition, group) gives each partition's offset
    within its group. ``order`` must make rows unique inside a group. The
    partition assignment is checkpointed once, so retries and both passes agree.
    """
    by = list(by)
    keys = [F.col(b) for b in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    n_parts = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range bounds are sampled with a per-execution seed, so the partition id is
    # written once (checkpoint) and both passes below read the same assignment
    ranged = materialize(df.repartitionByRange(n_parts, *keys).withColumn("_pid", F.spark_partition_id()))
    # numbering inside one range partition (bounded by the partition's size)
    w_local = Window.partitionBy("_pid", *by).orderBy(*keys[len(by):])
    local = ranged.withColumn("_lr", F.row_number().over(w_local))
    counts = ranged.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0)))
                          .select("_pid", *by, "_off"), "offsets")
    joined = join_same(local, offsets, ["_pid", *by])
    return joined.withColumn(out, (F.col("_off") + F.col("_lr")).cast("bigint")).drop("_pid", "_lr", "_off")
