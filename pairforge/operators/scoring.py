"""Batch scoring and a clone-classifier baseline.

* ``score`` wraps a user model function with ``predict_batch_udf``: Spark
  hands it Arrow batches of feature arrays, the model returns logits.
* ``clone_features`` turns a text pair into one vector: hashed term counts
  of each side (``HashingTF``), then ``|u - v|`` and ``u * v``.
* ``train_clone_baseline`` fits ``LogisticRegression`` on the train split
  and scores the rest; metrics come from the aggregate operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.functions.text import words


def score(df: DataFrame, features: str, make_predict_fn: Callable, n_in: int,
          batch_size: int = 256, out: str = "logits") -> DataFrame:
    """V5: logits from a user model (``make_predict_fn() -> fn(np.ndarray) -> np.ndarray``)
    over fixed-length feature arrays of ``n_in`` values."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
                            input_tensor_shapes=[[n_in]])
    return df.withColumn(out, udf(F.col(features)))


def logistic_logits(coefficients: list[float], intercept: float):
    """A model function for ``score``: the logits (-z, z) of a fitted logistic regression."""
    def make():
        import numpy as np
        w = np.asarray(coefficients, dtype="float64")

        def predict(x):
            z = x.reshape(len(x), len(w)) @ w + intercept
            return np.stack([-z, z], axis=1).astype("float32")
        return predict
    return make


def clone_features(df: DataFrame, a: str, b: str, num_features: int = 1024) -> DataFrame:
    """V6 features for a text pair."""
    tf_a = HashingTF(inputCol="_wa", outputCol="_va", numFeatures=num_features)
    tf_b = HashingTF(inputCol="_wb", outputCol="_vb", numFeatures=num_features)
    x = df.withColumn("_wa", words(F.lower(F.col(a)))).withColumn("_wb", words(F.lower(F.col(b))))
    x = tf_b.transform(tf_a.transform(x))
    u, v = vector_to_array(F.col("_va")), vector_to_array(F.col("_vb"))
    diff = F.zip_with(u, v, lambda p, q: F.abs(p - q))
    prod = F.zip_with(u, v, lambda p, q: p * q)
    return x.withColumn("features", array_to_vector(F.concat(diff, prod))).drop("_wa", "_wb", "_va", "_vb")


def fit_clone_model(pairs: DataFrame, a: str, b: str, label: str, split: str, num_features: int, max_iter: int):
    """(fitted model, all rows with ``features``): learnt from ``split == 'train'``."""
    feats = clone_features(pairs, a, b, num_features).withColumn(label, F.col(label).cast("double"))
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=0.01)
    return lr.fit(feats.filter(F.col(split) == "train")), feats


def train_clone_baseline(pairs: DataFrame, a: str = "func1", b: str = "func2", label: str = "label",
                         split: str = "split", num_features: int = 256, max_iter: int = 20) -> DataFrame:
    """Fit on ``split == 'train'``, return every row with ``prediction``."""
    model, feats = fit_clone_model(pairs, a, b, label, split, num_features, max_iter)
    return model.transform(feats).withColumn("prediction", F.col("prediction").cast("int"))


def score_pairs(pairs: DataFrame, a: str = "func1", b: str = "func2", label: str = "label", split: str = "split",
                num_features: int = 256, max_iter: int = 20) -> DataFrame:
    """V5 with the V6 model: every row with ``logits``, computed in Arrow batches."""
    model, feats = fit_clone_model(pairs, a, b, label, split, num_features, max_iter)
    x = feats.withColumn(label, F.col(label).cast("int")).withColumn("_x", vector_to_array("features"))
    fn = logistic_logits(model.coefficients.toArray().tolist(), float(model.intercept))
    return score(x, "_x", fn, 2 * num_features).drop("_x", "features")


def argmax_prediction(logits: Column) -> Column:
    """F11 over model output."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")
