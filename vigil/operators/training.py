"""Training, early stopping, model selection and scoring with MLlib (OP-12, OP-71..74, OP-76).

The feature table stays a DataFrame all the way into ``fit`` (nothing is collected).
Early stopping runs rounds of a few L-BFGS iterations, warm-started from the previous
round's weights, evaluates log loss on the real validation split after each round,
keeps the best model and stops after ``patience`` rounds without improvement.
Round length is part of the config because L-BFGS history restarts every round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import HashingTF, IDF, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark import StorageLevel

from vigil.config import TrainConfig
from vigil.functions.labels import decode_label, sensitive_flag
from vigil.functions.text import tokens
from vigil.operators.relational import token_bucket


def text_vectors(docs: DataFrame, text: str = "text", num_features: int = 1 << 12,
                 out: str = "tfidf", model: PipelineModel | None = None) -> tuple[DataFrame, PipelineModel]:
    """Hashed TF-IDF over the whole text (OP-47 re-aim). The IDF fit is one distributed
    pass; pass the fitted ``model`` to vectorise new rows with the training statistics."""
    with_tokens = docs.withColumn("__tokens", tokens(text))
    if model is None:
        model = Pipeline(stages=[HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=num_features),
                                 IDF(inputCol="__tf", outputCol=out)]).fit(with_tokens)
    return model.transform(with_tokens).drop("__tokens", "__tf"), model


def token_weights(docs: DataFrame, key: str, text: str = "text", num_features: int = 1 << 12) -> DataFrame:
    """``key, n_buckets, n_tokens, weight_sum`` of the hashed TF-IDF vector that the models use (OP-47).

    A token's place is its md5 (first 8 hex digits) modulo ``num_features``; its weight is
    ln((n + 1) / (df + 1)), and a vector's place holds the sum over its tokens. Tokens stay in their
    rows: only each row's distinct places are counted for the document frequencies (partial counts of at most
    ``num_features`` rows a task), which come back as one array (bounded by ``num_features``)."""
    rows = docs.select(key, F.transform(tokens(text), lambda w: token_bucket(w, num_features)).alias("__at"))
    df = rows.select(F.explode(F.array_distinct("__at")).alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("df"))
    total = docs.count()
    by_place = df.agg(F.map_from_entries(F.collect_list(F.struct("place", F.log((F.lit(total) + 1) / (F.col("df") + 1))))).alias("by")).first().by or {}
    idf = F.array(*[F.lit(float(by_place.get(p, 0.0))) for p in range(num_features)])
    weight = F.aggregate("__at", F.lit(0.0), lambda a, p: a + F.get(idf, p))
    return rows.select(key, F.size(F.array_distinct("__at")).cast("long").alias("n_buckets"), F.size("__at").cast("long").alias("n_tokens"),
                       F.round(weight, 4).alias("weight_sum"))


def balanced_copies(train: DataFrame, label: str = "label") -> DataFrame:
    """Rows of rare classes repeated so that each class has about the rows of the largest (for
    learners without row weights). The class histogram is one small aggregate."""
    counts = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    most = max(counts.values(), default=1)
    times = F.lit(1)
    for cls, n in counts.items():
        times = F.when(F.col(label) == F.lit(cls), F.lit(max(1, round(most / n)))).otherwise(times)
    return train.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).drop("__copy")


def feature_pipeline(array_cols: list[str], vector_cols: list[str]) -> Pipeline:
    """Assemble the modality blocks (late fusion input) and scale them."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=[*[f"__v_{c}" for c in array_cols], *vector_cols], outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="features", withMean=False, withStd=True),
    ])


def to_vectors(df: DataFrame, array_cols: list[str]) -> DataFrame:
    for c in array_cols:
        df = df.withColumn(f"__v_{c}", array_to_vector(F.col(c).cast("array<double>")))
    return df


@dataclass
class TrainResult:
    features: PipelineModel | None
    model: object
    history: list[tuple]
    best_round: int
    best_loss: float
    path: str | None = None  # where the best model was saved (OP-12)


def _loss_and_accuracy(pred: DataFrame) -> tuple[float, float]:
    """Mean log loss (probabilities clipped at 1e-15, as MLlib's evaluator does) and
    accuracy, in one aggregate over the scored rows."""
    p = F.get(vector_to_array("probability"), F.col("label").cast("int"))
    row = pred.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss"),
                   F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc")).first()
    return float(row.loss), float(row.acc)


def train_early_stop(train: DataFrame, val: DataFrame, n_classes: int, cfg: TrainConfig = TrainConfig(),
                     hidden: tuple[int, ...] | None = None) -> TrainResult:
    """``train``/``val`` carry ``features`` (vector) and ``label`` (double). The best round is that
    of the highest macro-F1 on ``val``; classes are balanced for the fit."""
    history: list[tuple] = []
    # every round re-reads both splits: keep them cached (spilling to disk if large)
    train = balanced_copies(train).persist(StorageLevel.MEMORY_AND_DISK)
    val = val.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_in = len(train.select("features").first()[0])
        layers = [n_in, *(cfg.hidden if hidden is None else hidden), n_classes]
        return _rounds(train, val, layers, cfg, history)
    finally:
        train.unpersist()
        val.unpersist()


def _rounds(train: DataFrame, val: DataFrame, layers: list[int], cfg: TrainConfig, history: list) -> TrainResult:
    best, best_f1, best_loss, best_round, weights, waited = None, -1.0, float("inf"), -1, None, 0
    for r in range(cfg.max_rounds):
        mlp = MultilayerPerceptronClassifier(layers=layers, maxIter=cfg.iters_per_round, seed=cfg.seed,
                                             blockSize=1024, solver="l-bfgs")
        if weights is not None:
            mlp = mlp.setInitialWeights(weights)
        model = mlp.fit(train)
        weights = model.weights
        pred = model.transform(val)
        loss, acc = _loss_and_accuracy(pred)
        f1 = macro_f1(model, val)
        improved = f1 > best_f1
        history.append((r, float(loss), float(acc), f1, improved))
        if improved:
            best, best_f1, best_loss, best_round, waited = model, f1, loss, r, 0
        else:
            waited += 1
            if waited >= cfg.patience:
                break
    return TrainResult(None, best, history, best_round, best_loss)


def balanced_weights(train: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Per-row weight n / (k * n_class): rare classes count as much as common ones.
    The class histogram is one small aggregate (one row per class)."""
    counts = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    n, k = sum(counts.values()), len(counts)
    expr = F.lit(1.0)
    for cls, c in counts.items():
        expr = F.when(F.col(label) == F.lit(cls), F.lit(n / (k * c))).otherwise(expr)
    return train.withColumn(out, expr)


def fit_linear(train: DataFrame, seed: int = 42, max_iter: int = 50, balanced: bool = True):
    lr = LogisticRegression(maxIter=max_iter, regParam=1e-3, family="multinomial")
    if balanced:
        return lr.setWeightCol("weight").fit(balanced_weights(train))
    return lr.fit(train)


def evaluate(model, df: DataFrame) -> tuple[float, float]:
    pred = model.transform(df)
    return _loss_and_accuracy(pred)


def macro_f1(model, df: DataFrame) -> float:
    """Mean per-class F1 on ``df`` (a class never predicted counts as F1 = 0)."""
    from vigil.operators.evaluate import class_metrics, per_class_counts

    pred = model.transform(df).withColumn("label", F.col("label").cast("int")) \
        .withColumn("prediction", F.col("prediction").cast("int"))
    row = class_metrics(per_class_counts(pred)).agg(F.avg(F.coalesce("f1", F.lit(0.0)))).first()
    return float(row[0])


def save_model(model, path: str) -> str:
    """Persist the best model (OP-12) to shared storage; returns the path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Restore a saved model (OP-12): the class is read from the saved metadata."""
    from pyspark.ml.util import DefaultParamsReader

    cls = DefaultParamsReader.loadMetadata(path, None)["class"]
    if cls.endswith("MultilayerPerceptronClassificationModel"):
        from pyspark.ml.classification import MultilayerPerceptronClassificationModel as M
    elif cls.endswith("LogisticRegressionModel"):
        from pyspark.ml.classification import LogisticRegressionModel as M
    else:
        from pyspark.ml import PipelineModel as M
    return M.load(path)


def score(model, df: DataFrame, class_names: list[str], keep: list[str]) -> DataFrame:
    """features -> probability -> prediction -> label name -> sensitive (OP-76)."""
    pred = model.transform(df)
    return pred.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                       decode_label(F.col("prediction").cast("int"), class_names).alias("predicted_label"),
                       sensitive_flag(decode_label(F.col("prediction").cast("int"), class_names)).alias("sensitive"),
                       F.array_max(vector_to_array("probability")).alias("confidence"))


def external_scores(df: DataFrame, features: str, make_predict_fn, input_dim: int, batch_size: int = 1024,
                    class_names: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Score with an external model (e.g. an exported network run by onnxruntime or
    numpy): ``make_predict_fn()`` is called once per Python worker and returns a
    function ``ndarray[batch, input_dim] -> ndarray[batch, n_classes]`` of logits. Batches are
    Arrow-transferred by ``predict_batch_udf``; softmax, argmax, label name and
    sensitive flag are then built-in expressions."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    from vigil.functions.scoring import argmax, softmax

    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(FloatType()), batch_size=batch_size,
                            input_tensor_shapes=[[input_dim]])
    keep = keep or []
    logits = df.select(*keep, udf(F.col(features).cast("array<float>")).alias("logits"))
    out = logits.select(*keep, "logits", softmax("logits").alias("probability"), argmax("logits").alias("prediction"))
    if class_names:
        name = decode_label("prediction", class_names)
        out = out.withColumn("predicted_label", name).withColumn("sensitive", sensitive_flag(name))
    return out


def linear_predict_fn(model):
    """Export a fitted multinomial ``LogisticRegressionModel`` as a numpy logits function."""
    import numpy as np

    w = model.coefficientMatrix.toArray().astype(np.float64)
    b = model.interceptVector.toArray().astype(np.float64)

    def make():
        def predict(x):
            return (np.asarray(x, dtype=np.float64) @ w.T + b).astype(np.float32)
        return predict
    return make
