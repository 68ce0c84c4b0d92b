"""Comparison of two runs: candidate sets, feature tables, splits and recall before and after."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = ["source1_id", "candidate_id"]


def candidate_sets(fresh: DataFrame, other: DataFrame) -> DataFrame:
    """For each source row: sizes of both sets, of what they share, and their Jaccard index."""
    a = fresh.select(*PAIR).distinct().withColumn("_a", F.lit(1))
    b = other.select(*PAIR).distinct().withColumn("_b", F.lit(1))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    out = a.join(b, PAIR, "full").groupBy("source1_id").agg(F.count("_a").alias("n_fresh"), F.count("_b").alias("n_other"), F.count(F.when(both, 1)).alias("n_shared"))
    return out.withColumn("jaccard", F.round(F.col("n_shared") / (F.col("n_fresh") + F.col("n_other") - F.col("n_shared")), 6))


def overlap(sets: DataFrame) -> DataFrame:
    """One row: mean Jaccard index, and shared candidates over fresh ones."""
    return sets.agg(F.round(F.avg("jaccard"), 6).alias("mean_jaccard"), F.round(F.sum("n_shared") / F.sum("n_fresh"), 6).alias("global_overlap"), F.count("*").alias("entities"))


def feature_tables(fresh: DataFrame, other: DataFrame, columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """(feature, compared, different, largest) over pairs that both tables have."""
    a = fresh.select(*PAIR, *[F.col(c).cast("double").alias(f"a_{i}") for i, c in enumerate(columns)])
    b = other.select(*PAIR, *[F.col(c).cast("double").alias(f"b_{i}") for i, c in enumerate(columns)])
    gaps = F.array(*[F.struct(F.lit(c).alias("feature"), F.abs(F.col(f"a_{i}") - F.col(f"b_{i}")).alias("gap")) for i, c in enumerate(columns)])
    rows = a.join(b, PAIR).select(F.explode(gaps).alias("g")).select("g.*")
    return rows.groupBy("feature").agg(F.count("*").alias("compared"), F.sum((~(F.coalesce("gap", F.lit(float("inf"))) <= tolerance)).cast("long")).alias("different"), F.max("gap").alias("largest"))


def recall_change(before: DataFrame, after: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: truth pairs found before, after, by both and only afterwards."""
    t = truth.select("source1_id", F.col("matched_id").alias("candidate_id")).distinct()
    mark = lambda df, name: df.select(*PAIR).distinct().withColumn(name, F.lit(1))
    m = t.join(mark(before, "_x"), PAIR, "left").join(mark(after, "_y"), PAIR, "left")
    x, y = F.col("_x").isNotNull(), F.col("_y").isNotNull()
    n = F.count("*")
    share = lambda c: F.when(n > 0, F.round(F.sum(c.cast("int")) / n, 6))
    return m.agg(n.alias("n_true"), share(x).alias("recall_before"), share(y).alias("recall_after"), F.coalesce(F.sum((x & y).cast("int")), F.lit(0)).alias("both"), F.coalesce(F.sum((y & ~x).cast("int")), F.lit(0)).alias("gained"))


def split_statistics(labeled: DataFrame, folds: DataFrame) -> DataFrame:
    """For each fold: source rows, pairs, positives and their rate."""
    out = labeled.join(folds, "source1_id").groupBy("fold").agg(F.countDistinct("source1_id").alias("entities"), F.count("*").alias("pairs"), F.sum("label").cast("long").alias("positives"))
    return out.withColumn("positive_rate", F.round(F.col("positives") / F.col("pairs"), 6))


def leaks(train: DataFrame, held: DataFrame, features: list[str], truth: DataFrame, ids: DataFrame) -> DataFrame:
    """(check, broken): rules that a held-out measurement must keep; every count should be 0."""
    counts = {
        "entities_in_both": train.select("source1_id").distinct().join(held.select("source1_id").distinct(), "source1_id", "left_semi"),
        "pairs_in_both": train.select(*PAIR).join(held.select(*PAIR), PAIR, "left_semi"),
        "repeated_train_pairs": train.groupBy(*PAIR).agg(F.count("*").alias("n")).where("n > 1"),
        "repeated_held_pairs": held.groupBy(*PAIR).agg(F.count("*").alias("n")).where("n > 1"),
        "held_ids_unknown": held.select("source1_id").distinct().join(ids, "source1_id", "left_anti"),
        "truth_outside_ids": truth.select("source1_id").distinct().join(ids, "source1_id", "left_anti"),
    }
    parts = [df.agg(F.count("*").alias("broken")).select(F.lit(name).alias("check"), "broken") for name, df in counts.items()]
    named = len([f for f in features if f in (*PAIR, "label", "prob_match") or f.startswith("matched")])
    parts.append(train.sparkSession.range(1).select(F.lit("labels_or_ids_as_features").alias("check"), F.lit(named).cast("long").alias("broken")))
    return reduce(DataFrame.unionByName, parts)

