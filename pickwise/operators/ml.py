"""Model operators on MLlib: keyed split, assembly + scaling fitted on the
training split, the three classifiers, evaluation, importance / coefficient
tables, model comparison, the draft-only baseline, prediction bands, export
and save/load.

Everything is distributed: fitting and evaluation run as Spark jobs; only
model parameters (one value per feature) come back to the driver, and the
small report tables built from them are bounded by the feature count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.functions import exprs as X
from pickwise.operators import grow as G
from pickwise.plans.guards import materialize
from pickwise.sources.views import split_flag

# Fixed values of the reference's model settings.
SEED = 42
LR_PARAMS = {"maxIter": 100, "regParam": 0.01}
LR_TOLERANCE = 1e-9  # stops the regression at its optimum, not just near it
GRADIENT_BOUND = 1e-6  # of every entry of the loss gradient at the fitted coefficients
RF_PARAMS = {"numTrees": 100, "maxDepth": 10, "seed": SEED}
GBT_PARAMS = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": SEED}
GROWN_ROWS = 2_000_000  # trees over more training rows are grown over binned blocks (operators/grow.py)
TARGET_ACCURACY, TARGET_AUC = 0.65, 0.70
BASELINE_FALLBACK = {"accuracy": 0.52, "auc": 0.50}
MODEL_ORDER = ("logistic_regression", "random_forest", "gradient_boosting")


# ---------------------------------------------------------------- split / scale
def split_keyed(df: DataFrame, key: str = "match_id") -> DataFrame:
    """Adds ``is_train``: a keyed 80/20 split, stable across partitionings and runs."""
    return df.withColumn("is_train", split_flag(key))


def assemble(df: DataFrame, feature_cols: Sequence[str], output: str = "raw_features") -> DataFrame:
    """VectorAssembler with invalid rows (NULL/NaN) skipped."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=output, handleInvalid="skip").transform(df)


def fit_scaler(assembled: DataFrame, input_col: str = "raw_features", output: str = "features") -> StandardScalerModel:
    """Unit-variance scaling without centring (x / sample stddev; constant column → 0)."""
    return StandardScaler(inputCol=input_col, outputCol=output, withStd=True, withMean=False).fit(assembled)


def scale_features(df: DataFrame, feature_cols: Sequence[str], train: DataFrame | None = None) -> tuple[DataFrame, StandardScalerModel]:
    """Assemble and scale ``df``; the scaler is fitted on ``train`` (default: ``df``)."""
    assembled = assemble(df, feature_cols)
    model = fit_scaler(assemble(train, feature_cols) if train is not None else assembled)
    return model.transform(assembled), model


def unpack(df: DataFrame, vector_col: str, names: Sequence[str], keep: Sequence[str] = ("match_id",), digits: int | None = None) -> DataFrame:
    arr = vector_to_array(F.col(vector_col))
    cols = [arr[i] for i in range(len(names))]
    if digits is not None:
        cols = [F.round(c, digits) for c in cols]
    return df.select(*keep, *[c.alias(n) for c, n in zip(cols, names)])


# ---------------------------------------------------------------- fitting
def _grown(rows: int | None, params: dict) -> bool:
    return rows is not None and rows > GROWN_ROWS and set(params) <= {"numTrees", "maxIter", "stepSize", "maxDepth", "seed"} and params["maxDepth"] > 0


def fit_logreg(train: DataFrame, features: str = "features", label: str = "label", rows: int | None = None, **params) -> Model:
    return LogisticRegression(featuresCol=features, labelCol=label, **{**LR_PARAMS, "tol": LR_TOLERANCE, **params}).fit(train)


def fit_forest(train: DataFrame, features: str = "features", label: str = "label", rows: int | None = None, **params) -> Model:
    """``rows`` is the number of training rows, if it is known (so in :func:`fit_gbt`)."""
    params = {**RF_PARAMS, **params}
    forest = RandomForestClassifier(featuresCol=features, labelCol=label, **params)
    return G.forest(forest, train, rows) if _grown(rows, params) else forest.fit(train)


def fit_gbt(train: DataFrame, features: str = "features", label: str = "label", rows: int | None = None, **params) -> Model:
    params = {**GBT_PARAMS, **params}
    boosting = GBTClassifier(featuresCol=features, labelCol=label, **params)
    return G.boosting(boosting, train, rows) if _grown(rows, params) else boosting.fit(train)


FITTERS = {"logistic_regression": fit_logreg, "random_forest": fit_forest, "gradient_boosting": fit_gbt}


def batch_score(model: Model, df: DataFrame, keep: Sequence[str] = ("match_id", "label")) -> DataFrame:
    """Scores a table: keep columns + prediction + P(label = 1)."""
    pred = model.transform(df)
    return pred.select(
        *keep, "prediction", vector_to_array("probability")[1].alias("radiant_win_probability")
    )


# ---------------------------------------------------------------- evaluation
def auc_mllib(predictions: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC").evaluate(predictions)


def multiclass_metric(predictions: DataFrame, metric: str, label: str = "label", prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName=metric).evaluate(predictions)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count) as doubles/bigint — one aggregate."""
    return df.groupBy(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def eval_prf(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (MLlib's definitions)
    from one confusion aggregate; the per-class tables are bounded by the class count."""
    cm = confusion_matrix(df, label, prediction).withColumnRenamed("count", "n")
    lab = cm.groupBy(F.col("label").alias("c")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp")
    )
    prd = cm.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("predicted"))
    pc = lab.join(prd, "c", "left").select(
        "support", "tp",
        F.when(F.coalesce(F.col("predicted"), F.lit(0)) == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("predicted")).alias("p"),
        F.when(F.col("support") == 0, F.lit(0.0)).otherwise(F.col("tp") / F.col("support")).alias("r"),
    )
    f1 = F.when(F.col("p") + F.col("r") == 0, F.lit(0.0)).otherwise(2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r")))
    sums = pc.agg(
        F.sum("support").alias("total"), F.sum("tp").alias("tp"),
        F.sum(F.col("p") * F.col("support")).alias("wp"), F.sum(F.col("r") * F.col("support")).alias("wr"),
        F.sum(f1 * F.col("support")).alias("wf"),
    )
    return sums.select(
        (F.col("tp") / F.col("total")).alias("accuracy"),
        (F.col("wp") / F.col("total")).alias("weighted_precision"),
        (F.col("wr") / F.col("total")).alias("weighted_recall"),
        (F.col("wf") / F.col("total")).alias("weighted_f1"),
    )


def eval_auc(df: DataFrame, score: str, label: str = "label", partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve with tied scores counted as 1/2; NULL if the
    labels hold one class only.

    AUC = Σ_s pos(s)·(neg(< s) + neg(s)/2) / (P·N) over distinct scores s.  The
    running sum of negatives is a two-level prefix sum over ranges of scores: the
    per-score counts are range-partitioned (as many ranges as shuffle partitions,
    so they grow with the data) and materialised, prefix sums run inside each
    range, and the offsets come from one row per range.
    """
    g = df.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg"),
    )
    ranged = g.repartitionByRange(partitions, "s") if partitions else g.repartitionByRange("s")
    g = materialize(ranged.withColumn("b", F.spark_partition_id()))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = g.groupBy("b").agg(F.sum("neg").alias("n")).select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    inner = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    c = g.withColumn("own", F.coalesce(F.sum("neg").over(inner), F.lit(0))).join(F.broadcast(offsets), "b")  # one row a range
    below = (F.col("off") + F.col("own")).cast("double") + 0.5 * F.col("neg")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return c.agg(
        F.when(pairs > 0, F.sum(F.col("pos") * below) / pairs).alias("auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def evaluate(predictions: DataFrame, label: str = "label") -> dict[str, float | None]:
    """Accuracy, weighted precision / recall / F1 (one confusion aggregate) and the
    exact AUC, over predictions materialised once for both jobs."""
    score = vector_to_array("rawPrediction")[1].alias("score")
    pred = materialize(predictions.select(label, "prediction", score))
    prf = eval_prf(pred, label, "prediction").first()
    return {
        "accuracy": prf["accuracy"],
        "auc_roc": eval_auc(pred, "score", label).first()["auc"],
        "precision": prf["weighted_precision"],
        "recall": prf["weighted_recall"],
        "f1": prf["weighted_f1"],
    }


# ---------------------------------------------------------------- report tables
def importance_table(values: DataFrame, top: int | None = None) -> DataFrame:
    """(rank, feature, importance) of (feature, importance) rows, by importance
    descending, then name; the first ``top`` ranks only if given."""
    w = Window.orderBy(F.desc("importance"), F.asc("feature"))  # one row per feature
    ranked = values.withColumn("rank", F.row_number().over(w))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("rank", "feature", "importance")


def feature_importance(model: Model, names: Sequence[str], top: int | None = None) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return importance_table(_spark().createDataFrame(rows, "feature string, importance double"), top)


def coefficient_table(values: DataFrame, top: int | None = None) -> DataFrame:
    """(feature, coefficient, abs_coefficient, intercept) of (feature, coefficient,
    intercept) rows, by |coefficient| descending, then name."""
    out = values.select("feature", "coefficient", F.abs("coefficient").alias("abs_coefficient"), "intercept")
    out = out.orderBy(F.desc("abs_coefficient"), F.asc("feature"))
    return out if top is None else out.limit(top)


def logreg_coefficients(model: Model, names: Sequence[str], top: int | None = None) -> DataFrame:
    rows = [(n, float(c), float(model.intercept)) for n, c in zip(names, model.coefficients.toArray())]
    return coefficient_table(_spark().createDataFrame(rows, "feature string, coefficient double, intercept double"), top)


def logreg_from(coefficients: Sequence[float], intercept: float) -> LogisticRegressionModel:
    """A logistic regression with given coefficients on the vector column ``features``."""
    java = JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel",
        "logreg_from", _py2java(_spark().sparkContext, Vectors.dense(list(coefficients))), float(intercept),
    )
    return LogisticRegressionModel(java)


COMPARISON_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("auc_roc", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("train_seconds", T.DoubleType()),
])


def model_comparison(results: dict[str, dict[str, float]]) -> DataFrame:
    """One row per model with the five metrics and the target checks."""
    spark = _spark()
    rows = [
        (i, name, *(None if results[name][m] is None else float(results[name][m]) for m in ("accuracy", "auc_roc", "precision", "recall", "f1")),
         float(results[name].get("train_seconds", 0.0)))
        for i, name in enumerate(n for n in MODEL_ORDER if n in results)
    ]
    df = spark.createDataFrame(rows, COMPARISON_SCHEMA)
    return df.withColumn("meets_accuracy_target", F.col("accuracy") >= TARGET_ACCURACY).withColumn(
        "meets_auc_target", F.col("auc_roc") >= TARGET_AUC
    )


def best_model(comparison: DataFrame) -> DataFrame:
    """Highest AUC; ties go to the first listed model."""
    return comparison.orderBy(F.desc_nulls_last("auc_roc"), F.asc("ordinal")).limit(1)


def draft_only_columns(feature_cols: Sequence[str]) -> list[str]:
    return [c for c in feature_cols if "pick" in c.lower() or "draft" in c.lower()]


def gain_table(cols: Sequence[str], base: dict[str, float], full: dict[str, float]) -> DataFrame:
    """Metrics of the draft-only model and the full model, and the gain between them."""
    row = (
        ",".join(cols), float(base["accuracy"]), float(base["auc"]), float(full["accuracy"]), float(full["auc_roc"]),
        float((full["accuracy"] - base["accuracy"]) * 100), float(full["auc_roc"] - base["auc"]),
    )
    return _spark().createDataFrame(
        [row],
        "draft_columns string, baseline_accuracy double, baseline_auc double, model_accuracy double, "
        "model_auc double, accuracy_gain_points double, auc_gain double",
    )


def draft_baseline_gain(train: DataFrame, test: DataFrame, feature_cols: Sequence[str], full_metrics: dict[str, float]) -> DataFrame:
    """Unregularised LR on the draft-only columns (same split), and the gain of the
    full model over it; the fixed fallback when no draft column exists."""
    cols = draft_only_columns(feature_cols)
    if cols:
        tr, scaler = scale_features(train, cols)
        te = scaler.transform(assemble(test, cols))
        m = evaluate(LogisticRegression(featuresCol="features", labelCol="label", maxIter=100, tol=LR_TOLERANCE).fit(tr).transform(te))
        base = {"accuracy": m["accuracy"], "auc": m["auc_roc"]}
    else:
        base = dict(BASELINE_FALLBACK)
    return gain_table(cols, base, full_metrics)


def prediction_bands(df: DataFrame, probability: str = "radiant_win_probability", keep: Sequence[str] = ("match_id",)) -> DataFrame:
    """Confidence band and advice for every prediction, with the predicted side and
    the probability of that side."""
    p = F.col(probability)
    return df.select(
        *keep,
        p.alias("radiant_win_probability"),
        F.when(p > 0.5, F.lit("Radiant")).otherwise(F.lit("Dire")).alias("predicted_winner"),
        F.when(p > 0.5, p).otherwise(1 - p).alias("predicted_probability"),
        X.band_strength(p).alias("confidence"),
        X.band_advice(p).alias("recommendation"),
    )


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()
