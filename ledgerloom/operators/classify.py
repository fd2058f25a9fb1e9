"""Classification: exact stratified splits, models, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators import forests
from ledgerloom.operators.boosting import Boosted, boost
from ledgerloom.operators.forests import Forest
from ledgerloom.operators.logit import fit_parts, held_out_scores
from ledgerloom.operators.ranks import hash_rank, range_order, ranged
from ledgerloom.session import cut_lineage

# Split, folds, L2 strength, forest size, iterations, forest depth (30 is Spark's maximum).
TEST_SHARE, FOLDS, C, TREES, MAX_ITER, SEED, DEPTH = 0.20, 5, 1.0, 200, 1000, 42, 30


def stratified_split(df: DataFrame, label: str, key: str, test: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add `is_test`: exactly round(test * n) rows of every class, chosen by seeded hash."""
    ranked = hash_rank(df, [label], key, seed)
    cut = F.floor(F.col("_size") * F.lit(test) + 0.5)
    return ranked.withColumn("is_test", F.col("_rank") <= cut).drop("_rank", "_size")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add `fold` 0..k-1 with class sizes that differ by at most one between folds."""
    ranked = hash_rank(df, [label], key, seed)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_size")


def upsample_minority(df: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Repeat the rows of every smaller class until it has as many rows as the largest; adds `copy` (1 = original).

    Each row is copied floor(target / n) times, and the first rows in seeded-hash order once more.
    """
    ranked = hash_rank(df, [label], key, seed)
    target = df.groupBy(label).agg(F.count("*").alias("n")).select(F.max("n")).scalar()
    copies = F.floor(target / F.col("_size")) + (F.col("_rank") <= target % F.col("_size")).cast("int")
    return ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).drop("_rank", "_size")


@dataclass(frozen=True)
class Scaler:
    """Column means and population deviations of the training rows."""

    means: dict[str, float]
    deviations: dict[str, float]
    rows: int

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str]) -> Scaler:
        aggs = [a for i, c in enumerate(columns) for a in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]
        row = df.agg(F.count("*").alias("n"), *aggs).first()
        return Scaler(
            {c: row[f"m{i}"] or 0.0 for i, c in enumerate(columns)},
            {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)},
            row["n"],
        )

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - self.means[c]) / self.deviations[c] for c in self.means})


def assembled(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return out.select(*extra, "features")


def logistic(train: DataFrame, features: Sequence[str], label: str, strength: float = C, max_iter: int = MAX_ITER):
    """(model, scaler): L2 logistic regression on standardised features, penalty 1 / (C n)."""
    scaler = Scaler.fit(train, features)
    rows = assembled(scaler.apply(train), features, [label])
    model = LogisticRegression(
        labelCol=label, maxIter=max_iter, regParam=1.0 / (strength * scaler.rows), elasticNetParam=0.0, standardization=False, tol=1e-8
    ).fit(rows)
    return model, scaler


def balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (classes * class size) per row; the class sizes come in as a scalar map."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    box = counts.select(F.map_from_entries(F.collect_list(F.struct(F.col(label), F.col("_n")))), F.sum("_n"), F.count("*"))
    row = box.first()
    sizes, total, classes = row[0], row[1], row[2]
    weights = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(total / (classes * n)))])
    return df.withColumn(name, weights[F.col(label)])


def forest(
    train: DataFrame, features: Sequence[str], label: str, trees: int = TREES, seed: int = SEED, balanced: bool = True, depth: int = DEPTH
):
    """Random forest; `depth` limits its trees. The reference has no limit, so the default is the largest that Spark takes.

    Grown by `forests.fit`: Spark's own forest holds every node at the driver, and unlimited trees have as many as rows.
    """
    return forests.fit(assembled(train, features, [label]), features, label, balanced, trees, depth, seed)


def tree(train: DataFrame, features: Sequence[str], label: str, depth: int = 5, seed: int = SEED):
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=seed).fit(assembled(train, features, [label]))


def boosted(train: DataFrame, features: Sequence[str], label: str, rounds: int = 20, depth: int = 5) -> Boosted:
    """Second-order boosted trees; see `boosting.boost` for the other parameters."""
    return boost(train, features, label, rounds, depth)


def predict(model, df: DataFrame, features: Sequence[str], keep: Sequence[str], scaler: Scaler | None = None) -> DataFrame:
    """keep columns + prediction (0/1) + score (probability of class 1)."""
    if isinstance(model, Boosted):
        return model.predict(df, keep)
    if isinstance(model, Forest):
        return model.predict(assembled(df, features, keep), keep)
    rows = assembled(scaler.apply(df) if scaler else df, features, keep)
    return model.transform(rows).select(
        *keep, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("score")
    )


def roc_auc(scored: DataFrame, label: str, score: str = "score", bins: int = 0) -> float:
    """Area under the ROC curve; `bins` = 0 uses every distinct score."""
    rows = scored.select(F.col(label).cast("double").alias(label), F.col(score).cast("double").alias(score))
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=bins).evaluate(rows)


def binary_report(scored: DataFrame, label: str, prediction: str = "prediction", score: str | None = None) -> DataFrame:
    """One row: confusion counts, precision, recall, F1 and support per class, accuracy, ROC AUC."""
    y, p = F.col(label), F.col(prediction)
    cells = scored.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = cells.select(
        "tp", "fp", "fn", "tn",
        share(tp, tp + fp).alias("precision_1"),
        share(tp, tp + fn).alias("recall_1"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_1"),
        (F.col("tp") + F.col("fn")).alias("support_1"),
        share(tn, tn + fn).alias("precision_0"),
        share(tn, tn + fp).alias("recall_0"),
        share(2 * tn, 2 * tn + fp + fn).alias("f1_0"),
        (F.col("tn") + F.col("fp")).alias("support_0"),
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )
    return out.withColumn("auc", F.lit(roc_auc(scored, label, score))) if score else out


def model_comparison(reports: dict[str, DataFrame], order: str = "f1_1") -> DataFrame:
    """Reports side by side, best first."""
    rows = [r.select(F.lit(name).alias("model"), "*") for name, r in reports.items()]
    return reduce(lambda a, b: a.unionByName(b), rows).orderBy(F.col(order).desc(), "model")


def agreement(first: DataFrame, second: DataFrame, key: str, prediction: str = "prediction") -> DataFrame:
    """Share of rows two models predict alike."""
    right = second.select(key, F.col(prediction).alias("_other"))
    rows = first.join(right, key)
    return rows.agg(F.count("*").alias("n"), F.avg((F.col(prediction) == F.col("_other")).cast("double")).alias("agreement"))


def coefficient_table(df: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """Coefficients of a logistic model, largest magnitude first."""
    rows = [(f, float(c)) for f, c in zip(features, model.coefficients)]
    table = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return table.orderBy(F.abs("coefficient").desc(), "feature")


def importance_table(df: DataFrame, model, features: Sequence[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def grouped_auc(scored: DataFrame, groups: Sequence[str], label: str, score: str = "score") -> DataFrame:
    """Exact area under the ROC curve per group (ties count half), NULL where a class is missing.

    Equal scores are counted first and the counts cut into ranges, so neither a hot score nor a hot group fills a task;
    only running sums per range cross from one range to the next.
    """
    keys = list(groups)
    y = F.col(label)
    counted = scored.filter(F.col(score).isNotNull() & y.isNotNull()).groupBy(*keys, F.col(score).alias("_s")).agg(
        F.count_if(y == 1).alias("_pos"), F.count_if(y != 1).alias("_neg")
    )
    rows = ranged(counted, [*keys, "_s"])
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(range_order()).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_range").agg(F.sum("_neg").alias("_n"))
    counts = counts.select(*[F.col(k).alias(f"_k{k}") for k in keys], F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{k}")) for k in keys], F.col("_range") == F.col("_r"))
    inside = Window.partitionBy(*keys, "_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_start") + F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    rows = rows.join(counts, on).withColumn("_won", F.col("_pos") * (below + F.col("_neg") / 2))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return rows.groupBy(*keys).agg(F.try_divide(F.sum("_won"), pairs).alias("auc"))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, key: str, k: int = FOLDS, seed: int = SEED, strength: float = C) -> DataFrame:
    """Logistic regression on exact stratified folds: AUC and accuracy per fold, with mean and deviation rows.

    All folds are fitted in the same passes (`logit.fit_parts`) and judged in one: the number of jobs does not grow with k.
    """
    folded = cut_lineage(stratified_folds(df.select(key, label, *features), label, key, k, seed))
    models = fit_parts(folded, features, label, "fold", strength)
    scored = held_out_scores(folded, models, "fold").filter(F.col("score").isNotNull())
    hit = F.avg(((F.col("score") > 0.5) == (F.col(label) == 1)).cast("double")).alias("accuracy")
    per = grouped_auc(scored, ["fold"], label).join(scored.groupBy("fold").agg(hit), "fold")
    per = cut_lineage(per.select(F.col("fold").cast("string").alias("fold"), "auc", "accuracy"))
    both = lambda f, name: per.agg(F.lit(name).alias("fold"), f("auc").alias("auc"), f("accuracy").alias("accuracy"))
    return per.unionByName(both(F.avg, "mean")).unionByName(both(F.stddev_pop, "std"))


def grid_search(df: DataFrame, features: Sequence[str], label: str, key: str, depths=(3, 5), trees=(20, 50), k: int = 3, seed: int = SEED) -> DataFrame:
    """Forest depth x size grid, mean AUC over exact stratified folds."""
    rows = assembled(stratified_folds(df, label, key, k, seed), features, [label, "fold"]).withColumn(label, F.col(label).cast("double"))
    rf = RandomForestClassifier(labelCol=label, seed=seed)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, list(depths)).addGrid(rf.numTrees, list(trees)).build()
    search = CrossValidator(
        estimator=rf, estimatorParamMaps=grid, numFolds=k, foldCol="fold", parallelism=4, seed=seed,
        evaluator=BinaryClassificationEvaluator(labelCol=label),
    ).fit(rows)
    out = [(int(g[rf.maxDepth]), int(g[rf.numTrees]), float(m)) for g, m in zip(grid, search.avgMetrics)]
    table = df.sparkSession.createDataFrame(out, "max_depth int, num_trees int, mean_auc double")
    return table.orderBy(F.col("mean_auc").desc(), "max_depth", "num_trees")
