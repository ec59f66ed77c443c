"""Binary and multi-class evaluation as distributed aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(frame: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n, share of the label's rows). Pairs that do not occur are left out."""
    counts = frame.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col("label").alias("_label")).agg(F.sum("n").alias("_total"))
    return counts.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select("label", "prediction", "n", (F.col("n") / F.col("_total")).alias("share"))


def accuracy(frame: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (accuracy, n): the share of right predictions among rows with both; null without rows."""
    return frame.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion_matrix(frame: DataFrame, categories: int, label: str = "label", prediction: str = "prediction") -> tuple[list[list[float]], float]:
    """The row-normalised matrix, with NaN for a label without rows, and the accuracy."""
    found = {(int(r.label), int(r.prediction)): r.n for r in confusion(frame.where(F.col(label).between(0, categories - 1) & F.col(prediction).between(0, categories - 1)), label, prediction).collect()}
    rows = [[found.get((a, b), 0) for b in range(categories)] for a in range(categories)]
    total = sum(map(sum, rows))
    accuracy = sum(rows[k][k] for k in range(categories)) / total if total else float("nan")
    return [[x / sum(r) if sum(r) else float("nan") for x in r] for r in rows], accuracy


def _counted(frame: DataFrame, label: str, score: str) -> DataFrame:
    """(score, positives, negatives): rows at each distinct score. Rows with a null are left out."""
    rows = frame.select(F.col(label).cast("double").alias("y"), F.col(score).cast("double").alias("score")).where("y is not null and score is not null")
    return rows.groupBy("score").agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)).alias("p"), F.sum(F.when(F.col("y") > 0, 0).otherwise(1)).alias("n"))


def rank_auc(frame: DataFrame, label: str = "label", score: str = "score", chunks: int = 256) -> DataFrame:
    """One row (auc, positives, negatives) by ranks; ties count half. The auc is null without both classes.

    Negatives below each score are counted in two steps, by ranges of scores and within them, so no
    task holds all scores.
    """
    each = _counted(frame, label, score)
    found = each.select(F.percentile_approx("score", [k / chunks for k in range(1, chunks)], 10_000)).first()[0] if chunks > 1 else None
    bounds = F.array(*[F.lit(float(x)) for x in found or []]).cast("array<double>")
    placed = each.select("score", "p", "n", F.size(F.filter(bounds, lambda x: x < F.col("score"))).alias("part"))
    sums = placed.groupBy("part").agg(F.sum("n").alias("all_n"))
    before = sums.select("part", (F.sum("all_n").over(Window.orderBy("part")) - F.col("all_n")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("score")) - F.col("n")
    below = placed.withColumn("within", within).join(before, "part")
    pairs = below.agg(F.sum(F.col("p") * (F.col("before") + F.col("within") + F.col("n") / 2)).alias("won"), F.sum("p").alias("positives"), F.sum("n").alias("negatives"))
    return pairs.select(F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("won") / (F.col("positives") * F.col("negatives"))).alias("auc"), F.coalesce("positives", F.lit(0)).alias("positives"), F.coalesce("negatives", F.lit(0)).alias("negatives"))


def binned(frame: DataFrame, bins: int = 1000, label: str = "label", score: str = "score") -> DataFrame:
    """(bin, positives, negatives): scores from the smallest to the largest in equal bins, the largest in the last; one bin if all are equal."""
    rows = frame.select(F.col(label).cast("double").alias("y"), F.col(score).cast("double").alias("s")).where("y is not null and s is not null")
    low, high = rows.agg(F.min("s"), F.max("s")).first()
    share = (F.col("s") - F.lit(low)) / F.lit(high - low) if low is not None and high > low else F.lit(0.0)
    placed = rows.select("y", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int").alias("bin"))
    return placed.groupBy("bin").agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)).alias("positives"), F.sum(F.when(F.col("y") > 0, 0).otherwise(1)).alias("negatives"))


def roc(frame: DataFrame, bins: int = 1000, label: str = "label", score: str = "score") -> DataFrame:
    """(bin, tpr, fpr): shares of positives and negatives in this bin and those above. There are at most ``bins`` rows."""
    counts = binned(frame, bins, label, score)
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    rate = lambda c: F.when(F.sum(c).over(whole) > 0, F.sum(c).over(above) / F.sum(c).over(whole))
    return counts.select("bin", rate("positives").alias("tpr"), rate("negatives").alias("fpr"))


def binned_auc(frame: DataFrame, bins: int = 1000, label: str = "label", score: str = "score") -> DataFrame:
    """One row (auc): pairs within a bin count half; null without both classes."""
    counts = binned(frame, bins, label, score)
    below = F.sum("negatives").over(Window.orderBy("bin")) - F.col("negatives")
    sums = counts.withColumn("below", below).agg(F.sum(F.col("positives") * (F.col("below") + F.col("negatives") / 2)).alias("won"), F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    return sums.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("won") / (F.col("p") * F.col("n"))).alias("auc"))
