"""Where to go next: the best cells around each origin cell per hour and day of week."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.config import Settings
from cabgrid.functions import scalars
from cabgrid.functions.hexgrid import neighbours, steps_around

SLOT = ("hour_of_day", "day_of_week")


def candidate_cells(cells: DataFrame, k: int, cell: str = "pickup_h3") -> DataFrame:
    """Each cell with the cells around it: ``(origin_h3, candidate_h3)``."""
    return cells.select(
        F.col(cell).alias("origin_h3"), F.explode(neighbours(cell, k)).alias("candidate_h3")
    )


def candidates(typical: DataFrame, k: int, tasks: int | None = None) -> DataFrame:
    """Pairs of origin and candidate that both have demand in a slot.

    "Within ``k`` steps" holds both ways, so every row offers itself to the
    origins around it and already carries its demand. What is left to check is
    that the origin has demand in the slot too. That is one shuffle of the
    pairs by origin and slot, which scoring and ranking use again. A row makes up
    to ``3 k (k + 1)`` pairs; ``tasks`` says over how many tasks they are made
    (the number of shuffle partitions if not given).
    """
    roles = {"pickup_h3": "candidate_h3", "typical_demand": "candidate_demand", "demand_p75": "candidate_p75"}
    # Adaptive execution would merge the small partitions again, but for a stated number of them.
    tasks = tasks or int(typical.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = typical.repartition(tasks, "pickup_h3", *SLOT)
    offered = spread.withColumnsRenamed(roles).withColumn("step", F.explode(steps_around(k)))
    kept = [c for c in offered.columns if c not in ("step", "candidate_h3", *SLOT)]
    pairs = offered.selectExpr(
        "candidate_h3 - step.offset AS origin_h3",
        *SLOT,
        "candidate_h3",
        "step.grid_distance AS grid_distance",
        *kept,
    )
    origins = typical.select(F.col("pickup_h3").alias("origin_h3"), *SLOT)
    return pairs.join(origins, ["origin_h3", *SLOT], "left_semi")


def add_charger_score(typical: DataFrame, cell_scores: DataFrame) -> DataFrame:
    """Charger score of each cell, 0 where none is known. Done before rows fan out."""
    scores = cell_scores.withColumnRenamed("h3_cell", "pickup_h3")
    return typical.join(scores, "pickup_h3", "left").na.fill(0.0, subset=["charger_score"])


def score(pairs: DataFrame, settings: Settings) -> DataFrame:
    """Add the scaled terms and the final score, per origin and slot."""
    group = Window.partitionBy("origin_h3", *SLOT)
    weights = settings.weights
    terms = {"norm_demand": "candidate_demand", "norm_distance": "grid_distance", "norm_charger": "charger_score"}
    extremes = {}
    for name in terms.values():
        extremes[f"{name}_low"] = F.min(name).over(group)
        extremes[f"{name}_high"] = F.max(name).over(group)
    return (
        pairs.withColumns(extremes)
        .withColumns(
            {
                term: scalars.min_max(name, f"{name}_low", f"{name}_high", weights.epsilon)
                for term, name in terms.items()
            }
        )
        .withColumn("final_score", scalars.final_score(*terms, weights))
        .drop(*extremes)
    )


def top_candidates(scored: DataFrame, top: int) -> DataFrame:
    """Rank 1..top per origin and slot; equal scores go to the lower cell id."""
    best_first = Window.partitionBy("origin_h3", *SLOT).orderBy(F.desc("final_score"), F.asc("candidate_h3"))
    return (
        scored.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= top)
        .select(
            "origin_h3",
            *SLOT,
            "candidate_h3",
            "grid_distance",
            "candidate_demand",
            "charger_score",
            "final_score",
            "rank",
        )
    )


def recommendations(typical: DataFrame, cell_scores: DataFrame, settings: Settings) -> DataFrame:
    """The recommendations table."""
    pairs = candidates(add_charger_score(typical, cell_scores), settings.ring)
    return top_candidates(score(pairs, settings), settings.top)
