"""Models and their evaluation (M1–M16) on Spark ML.

Training uses ``pyspark.ml`` estimators (distributed fitting).  Every metric,
curve and confusion matrix is a DataFrame aggregation over (label, score) or
(actual, predicted) — never a ``toPandas`` of the predictions.  Curves group by
distinct score first and use the skew-safe prefix sums for the running counts.
"""

from __future__ import annotations

import logging

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import bin_edges, bin_index, bind_scalar, qcol
from ..functions.prefix import prefix_by_key
from ..session import cut_lineage
from .features import classification_target, numeric_feature_columns, split, split_stratified
from .forest import fit_forest
from .report import _histogram_of

log = logging.getLogger(__name__)


def _assembled(df: DataFrame, feats: list[str]) -> DataFrame:
    cols = [F.coalesce(F.nanvl(qcol(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0)).alias(c)
            for c in feats]
    rest = [qcol(c) for c in df.columns if c not in feats]
    return df.select(*rest, *cols)


def balanced_weights(df: DataFrame, label: str, weight: str = "_w") -> DataFrame:
    """weight = n / (n_classes · n_class) — scikit-learn's "balanced" (two classes)."""
    base, st = bind_scalar(df, df.agg(F.struct(F.count(F.lit(1)).alias("n"),
                                                F.sum(qcol(label)).alias("n1"))).scalar(), "_cw")
    n, n1 = st.getField("n"), st.getField("n1")
    w = F.when(qcol(label) == 1, n / (2 * n1)).otherwise(n / (2 * (n - n1)))
    return base.withColumn(weight, w.cast("double")).drop("_cw")


def train_logreg(train: DataFrame, feats: list[str], label: str, balanced: bool = True, max_iter: int = 1000,
                 tol: float = 1e-6) -> PipelineModel:
    """M1 / M2: L2 logistic regression equal to scikit-learn's C=1 objective:
    Spark minimises the weighted mean loss + regParam/2·‖w‖², so regParam =
    1 / Σweights (= 1 / n_train, since balanced weights sum to n)."""
    # Spark ML resolves column params as paths, so a label like "high_value_q0.80"
    # is trained under an internal name.
    data = _assembled(train.withColumn("_label", qcol(label).cast("double")), feats).select(*[qcol(c) for c in feats], "_label")
    data = data.persist()                   # read for the count, the weights, the summary and the fit
    n = data.count()                        # one number, needed as a parameter
    weighted = balanced_weights(data, "_label") if balanced else data
    extra = {"weightCol": "_w"} if balanced else {}
    lr = LogisticRegression(featuresCol="features", labelCol="_label", maxIter=max_iter, tol=tol,
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, **extra)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"), lr])
    try:
        return pipe.fit(weighted)
    finally:
        data.unpersist()


def score_logreg(model: PipelineModel, df: DataFrame, feats: list[str], threshold: float = 0.5) -> DataFrame:
    """M3: probability of class 1 (``score``) and ``pred`` = score >= threshold."""
    p = model.transform(_assembled(df, feats).drop("_label"))
    score = vector_to_array(F.col("probability"))[1]
    return p.withColumn("score", score).drop("features", "rawPrediction", "probability", "prediction") \
            .withColumn("pred", (F.col("score") >= threshold).cast("int"))


def threshold_predict(scored: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    return scored.withColumn("pred", (F.col(score) >= threshold).cast("int"))


def classification_metrics(scored: DataFrame, label: str, pred: str = "pred") -> DataFrame:
    """M4: accuracy, precision, recall, F1 (zero division -> 0), n_test — one pass."""
    y, p = qcol(label), F.col(pred)
    m = scored.agg(F.count(F.lit(1)).alias("n"),
                   F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                   F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if(y == p).alias("ok"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp").cast("double"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
                    F.lit(0.0))
    return m.select(F.try_divide(F.col("ok").cast("double"), F.col("n")).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), F.col("n").alias("n_test"))


def _score_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg) per distinct score."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(qcol(label) == 1).cast("double").alias("pos"),
        F.count_if(qcol(label) == 0).cast("double").alias("neg"))


def roc_auc(scored: DataFrame, label: str, score: str = "score") -> DataFrame:
    """M5: exact ROC-AUC with ties counted half (Mann–Whitney form), as one row."""
    g = _score_counts(scored, label, score).where(F.col("score").isNotNull()).withColumn("_k", F.lit(1))
    p = prefix_by_key(g, "_k", ["score"], "neg")        # negatives with a lower score
    return p.agg(F.try_divide(F.sum(F.col("pos") * (F.col("_prev_sum") + 0.5 * F.col("neg"))),
                              F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def _running_from_top(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, tp, fp, P, N): positives / negatives at or above each distinct score."""
    g = _score_counts(scored, label, score).where(F.col("score").isNotNull()) \
        .withColumn("_k", F.lit(1)).withColumn("_desc", -F.col("score"))
    run = prefix_by_key(g, "_k", ["_desc"], ["pos", "neg"]).select(
        "score", (F.col("_prev_sum_pos") + F.col("pos")).alias("tp"), (F.col("_prev_sum_neg") + F.col("neg")).alias("fp"))
    tot = g.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    j, tot = bind_scalar(run, tot, "_tot")
    return j.select("score", "tp", "fp", tot.getField("P").alias("P"), tot.getField("N").alias("N"))


def roc_curve(scored: DataFrame, label: str, score: str = "score") -> DataFrame:
    """M7: (threshold, fpr, tpr), one point per distinct score."""
    r = _running_from_top(scored, label, score)
    return r.select(F.col("score").alias("threshold"), F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def pr_curve(scored: DataFrame, label: str, score: str = "score") -> DataFrame:
    """M8: (threshold, precision, recall), one point per distinct score."""
    r = _running_from_top(scored, label, score)
    return r.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("recall"))


def confusion_matrix(scored: DataFrame, label: str, pred: str = "pred") -> DataFrame:
    """M6: all four (label, pred) cells with their counts (absent cells -> 0)."""
    counts = scored.groupBy(qcol(label).cast("int").alias("label"), F.col(pred).cast("int").alias("pred")) \
                   .agg(F.count(F.lit(1)).alias("n"))
    cells = scored.sparkSession.range(4).select((F.col("id") / 2).cast("int").alias("label"),
                                                (F.col("id") % 2).cast("int").alias("pred"))
    return cells.join(counts, ["label", "pred"], "left").select(
        "label", "pred", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("count"))


def logreg_coefficients(model: PipelineModel, feats: list[str]) -> DataFrame:
    """M9: (feature, coef, abs_coef) sorted by |coef| descending."""
    lr = model.stages[-1]
    rows = [(f, float(c), abs(float(c))) for f, c in zip(feats, lr.coefficients.toArray())]
    df = SparkSession.getActiveSession().createDataFrame(rows, "feature string, coef double, abs_coef double")
    return df.orderBy(F.desc("abs_coef"), F.asc("feature"))


def logreg_optimality(model: PipelineModel, train: DataFrame, feats: list[str], label: str, balanced: bool = True) -> DataFrame:
    """(parameter, gradient) of the training objective at the model, one scan: near 0 at the optimum, wherever the solver stopped.

    The objective is ``train_logreg``'s; a feature's gradient is divided by the feature's standard deviation (by 1
    if that is 0), so that all are on one scale.  The last row is the intercept's.
    """
    lr = model.stages[-1]
    data = train.withColumn("_label", qcol(label).cast("double"))
    data = balanced_weights(data, "_label") if balanced else data.withColumn("_w", F.lit(1.0))
    p = model.stages[-1].transform(model.stages[0].transform(_assembled(data, feats)))
    p = p.withColumn("_e", F.col("_w") * (vector_to_array(F.col("probability"))[1] - F.col("_label")))
    cells = [F.sum(F.col("_e") * qcol(c)).alias(f"g{i}") for i, c in enumerate(feats)]
    cells += [F.stddev_pop(qcol(c)).alias(f"s{i}") for i, c in enumerate(feats)]
    row = p.agg(F.sum("_w").alias("w"), F.sum("_e").alias("e"), *cells).first()
    reg = lr.getRegParam()
    out = [(c, (row[f"g{i}"] / row["w"] + reg * float(lr.coefficients[i])) / (row[f"s{i}"] or 1.0)) for i, c in enumerate(feats)]
    return train.sparkSession.createDataFrame([*out, ("(intercept)", row["e"] / row["w"])], "parameter string, gradient double")


def train_forest(train: DataFrame, feats: list[str], label: str, num_trees: int = 250, max_depth: int = 30,
                 seed: int = 42, max_bins: int = 64, memory_mb: int = 1024) -> PipelineModel:
    """Random-forest regression (all features at every split, no
    subsampling, like scikit-learn's defaults; trees grow to Spark's deepest level,
    30, and splits are binned).  ``memory_mb`` bounds what a task holds of the
    cells that the trees are grown on (see ``forest``)."""
    return fit_forest(_assembled(train.withColumn("_label", qcol(label).cast("double")), feats), feats, num_trees, max_depth, seed, max_bins, memory_mb)


def predict_forest(model: PipelineModel, df: DataFrame, feats: list[str]) -> DataFrame:
    """The rows with their ``prediction``.  Where feature vectors repeat, each is sent through the trees once."""
    x = _assembled(df, feats).drop("features", "_label")
    st = x.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.struct(*[qcol(c) for c in feats])).alias("k")).first()
    if 4 * st["k"] > st["n"]:
        return model.transform(x).drop("features")
    known = model.transform(x.select(*[qcol(c) for c in feats]).distinct()).drop("features")
    return x.join(known, feats).select(*[qcol(c) for c in x.columns], "prediction")


def regression_metrics(pred: DataFrame, actual: str, predicted: str = "prediction") -> DataFrame:
    """RMSE, MAE, R² (1 − SSE/SST, SST = n·var_pop), n — one pass."""
    y, p = qcol(actual).cast("double"), qcol(predicted).cast("double")
    m = pred.agg(F.count(F.lit(1)).alias("n"), F.sum((y - p) * (y - p)).alias("sse"),
                 F.sum(F.abs(y - p)).alias("sae"), (F.var_pop(y) * F.count(y)).alias("sst"))
    return m.select(F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), (F.col("sae") / F.col("n")).alias("mae"),
                    (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"), F.col("n").alias("n_test"))


def residual_histogram(pred: DataFrame, actual: str, predicted: str = "prediction", bins: int = 30) -> DataFrame:
    """Histogram of actual − predicted."""
    x = pred.select((qcol(actual) - qcol(predicted)).cast("double").alias("x")).where(F.col("x").isNotNull())
    return _histogram_of(x, bins)


def actual_vs_predicted_bins(pred: DataFrame, actual: str, predicted: str = "prediction", bins: int = 20) -> DataFrame:
    """The scatter as 2-D bin counts over a common [min, max] range."""
    v = pred.select(qcol(actual).cast("double").alias("a"), qcol(predicted).cast("double").alias("p")) \
            .where(F.col("a").isNotNull() & F.col("p").isNotNull())
    mm = v.agg(F.least(F.min("a"), F.min("p")).alias("mn"), F.greatest(F.max("a"), F.max("p")).alias("mx"))
    lo, width = bin_edges(F.col("mn"), F.col("mx"), bins)
    v, st = bind_scalar(v, mm.select(F.struct(lo.alias("lo"), width.alias("w"))).scalar())
    lo, width = st.getField("lo"), st.getField("w")
    return (v.select(bin_index(F.col("a"), lo, width, bins).alias("actual_bin"),
                     bin_index(F.col("p"), lo, width, bins).alias("pred_bin"))
             .groupBy("actual_bin", "pred_bin").agg(F.count(F.lit(1)).alias("count")))


def forest_importances(model: PipelineModel, feats: list[str], top_k: int = 20) -> DataFrame:
    """(feature, importance), top k by importance."""
    rf = model.stages[-1]
    rows = sorted(((f, float(v)) for f, v in zip(feats, rf.featureImportances.toArray())),
                  key=lambda z: (-z[1], z[0]))[:top_k]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> str:
    """Persist (overwrite) and return the path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


class TasksFailed(RuntimeError):
    """A model task failed.  ``result`` holds what was made, with the error of each failed task under ``failed``."""

    def __init__(self, result: dict):
        super().__init__("; ".join(f"{task} failed: {why}" for task, why in result["failed"].items()))
        self.result = result


def run_ml(features: DataFrame, cfg: dict, models_dir: str | None = None) -> dict:
    """Classification then regression on the built features; each task's
    failure is logged and the other still runs, then ``TasksFailed`` is raised,
    so that what is returned is whole; disabled -> empty result.
    ``features`` must carry the boolean split flag ``is_test``."""
    ml_cfg = cfg.get("ml") or {}
    result = {"metrics": {}, "tables": {}, "models": {}, "failed": {}}
    if not ml_cfg or not ml_cfg.get("enabled", True):
        return result
    if "is_test" not in features.columns:
        raise ValueError("run_ml needs an is_test split flag")
    ccfg = ml_cfg.get("classification") or {}
    if ccfg.get("enabled", True):
        try:
            x, y = classification_target(features, ccfg.get("target"), float(ccfg.get("threshold_q", 0.8)))
            feats = numeric_feature_columns(x, drop=[y, "amount"])
            if ccfg.get("stratify", True):              # the same share of either class is held out
                x = cut_lineage(split_stratified(x.drop("is_test"), y, "order_id" if "order_id" in x.columns else None))
            train, test = x.where(~F.col("is_test")), x.where(F.col("is_test"))
            model = train_logreg(train, feats, y, tol=float(ccfg.get("tol", 1e-6)))
            scored = score_logreg(model, test, feats)
            n_train = train.agg(F.count(F.lit(1))).scalar()
            m = classification_metrics(scored, y).select("*", F.lit(y).alias("target"), n_train.alias("n_train"),
                                                               roc_auc(scored, y).scalar().alias("roc_auc"))
            result["metrics"]["classification"] = m
            result["tables"].update({"clf_confusion": confusion_matrix(scored, y), "clf_roc": roc_curve(scored, y),
                                     "clf_pr": pr_curve(scored, y), "clf_auc": roc_auc(scored, y),
                                     "logreg_coeffs": logreg_coefficients(model, feats)})
            if models_dir:
                result["models"]["logreg_high_value"] = save_model(model, f"{models_dir}/logreg_high_value")
        except Exception as e:  # noqa: BLE001 — reference semantics: log and go on; raised below
            log.exception("classification failed: %s", e)
            result["failed"]["classification"], cause = f"{type(e).__name__}: {e}", e
    rcfg = ml_cfg.get("regression") or {}
    target = rcfg.get("target") or "amount"
    if rcfg.get("enabled", True) and (rcfg.get("target") or target in features.columns):
        try:
            if target not in features.columns:
                raise ValueError(f"no column {target!r} to predict")
            x = features.where(F.col(target).isNotNull())
            feats = numeric_feature_columns(x, drop=[target])
            train, test = x.where(~F.col("is_test")), x.where(F.col("is_test"))
            model = train_forest(train, feats, target, int(rcfg.get("n_estimators", 250)),
                                 int(rcfg.get("max_depth", 30)))
            pred = predict_forest(model, test, feats)
            n_train = train.agg(F.count(F.lit(1))).scalar()
            result["metrics"]["regression"] = regression_metrics(pred, target).select("*",
                                                                                      n_train.alias("n_train"))
            result["tables"].update({"rf_importance": forest_importances(model, feats),
                                     "reg_residuals": residual_histogram(pred, target),
                                     "reg_scatter": actual_vs_predicted_bins(pred, target)})
            if models_dir:
                result["models"]["rf_amount"] = save_model(model, f"{models_dir}/rf_amount")
        except Exception as e:  # noqa: BLE001
            log.exception("regression failed: %s", e)
            result["failed"]["regression"], cause = f"{type(e).__name__}: {e}", e
    if result["failed"]:
        raise TasksFailed(result) from cause
    return result


__all__ = ["train_logreg", "score_logreg", "threshold_predict", "classification_metrics", "roc_auc", "roc_curve",
           "pr_curve", "confusion_matrix", "logreg_coefficients", "train_forest", "predict_forest",
           "regression_metrics", "residual_histogram", "actual_vs_predicted_bins", "forest_importances",
           "save_model", "load_model", "run_ml", "TasksFailed", "split"]


def _split_all(df: DataFrame, key: str | None) -> DataFrame:
    return split(df, key)


def train_classification(df: DataFrame, target: str, key: str | None = None) -> DataFrame:
    """M2: plain logistic regression on every other column (numeric), 75/25 hash
    split; one metrics row (model, accuracy, precision, recall, f1, roc_auc)."""
    x = _split_all(df.withColumn(target, qcol(target).cast("int")), key)
    feats = numeric_feature_columns(x, drop=[target] + ([key] if key else []))
    train, test = x.where(~F.col("is_test")), x.where(F.col("is_test"))
    model = train_logreg(train, feats, target, balanced=False)
    scored = score_logreg(model, test, feats)
    m = classification_metrics(scored, target).drop("n_test")
    auc = roc_auc(scored, target).scalar()
    return m.select(F.lit("LogisticRegression").alias("model"), "*", auc.alias("roc_auc"))


def train_regression(df: DataFrame, target: str, key: str | None = None, num_trees: int = 200,
                     max_depth: int = 30) -> DataFrame:
    """Random forest (200 trees) on every other numeric column; one metrics
    row (model, rmse, mae, r2)."""
    x = _split_all(df.where(F.col(target).isNotNull()), key)
    feats = numeric_feature_columns(x, drop=[target] + ([key] if key else []))
    train, test = x.where(~F.col("is_test")), x.where(F.col("is_test"))
    model = train_forest(train, feats, target, num_trees, max_depth)
    m = regression_metrics(predict_forest(model, test, feats), target).drop("n_test")
    return m.select(F.lit("RandomForestRegressor").alias("model"), "*")
