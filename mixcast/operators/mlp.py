"""K4, K5: multilayer perceptrons trained data-parallel on Spark.

Spark ML has no neural regressor, so the fit is a Spark job per epoch:

* the weights (about 11k numbers for 6-128-64-32-1) are broadcast;
* every partition runs mini-batch Adam steps (ReLU, squared loss) over its own rows,
  starting from the broadcast weights, and gives its updated parameters weighted by
  its row count; the rows are packed into arrays once, and every epoch reads those;
* a ``treeAggregate`` adds them up across partitions (only the sum of ~11k numbers
  comes back);
* the loss on a hash-held-out validation share decides early stopping.

Features are the same scaled / one-hot columns as the ML pipelines.

The classifier is that of ``MultilayerPerceptronClassifier``: its network (sigmoid layers, softmax, mean cross entropy), its
first weights, its L-BFGS (line search, memory and stopping rule are those of Breeze, which Spark calls) and its model
class.  Spark stacks blocks of 128 rows anew for every evaluation and multiplies them in the JVM; here rows are packed once
and an evaluation multiplies them in numpy, one job each: single precision for a thousand rows at a time, double for the
sums over them, the search and the weights (errors of 1e-6; Spark's mean of block means differs by more between partitionings).
"""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import hash_unit
from ..schema import CATEGORIES, CATEGORY, KEY, SEED, TARGET_REG
from .features import fit_scaling

FEATURES = ["TV_z", "Radio_z", "Social_Media_z", "Influencer_Macro", "Influencer_Micro", "Influencer_Nano"]


def _with_features(df: DataFrame, scaling: dict) -> DataFrame:
    """Scaled channels (frozen train statistics) and the one-hot tier, as in the ML pipelines."""
    return df.select("*", *[((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(f"{c}_z")
                            for c, (m, s) in scaling.items()],
                     *[F.coalesce(F.col(CATEGORY) == F.lit(c), F.lit(False)).cast("double").alias(f"{CATEGORY}_{c}")
                       for c in CATEGORIES[1:]])


def _init(layers, seed):
    rng = np.random.default_rng(seed)
    params = []
    for a, b in zip(layers[:-1], layers[1:]):
        bound = np.sqrt(6.0 / (a + b))  # Glorot uniform, as scikit-learn initialises
        params += [rng.uniform(-bound, bound, (a, b)), rng.uniform(-bound, bound, b)]
    return params


def _flat(params):
    return np.concatenate([p.ravel() for p in params])


def _unflat(vec, layers):
    out, i = [], 0
    for a, b in zip(layers[:-1], layers[1:]):
        out.append(vec[i:i + a * b].reshape(a, b))
        i += a * b
        out.append(vec[i:i + b])
        i += b
    return out


def _forward(params, x):
    acts = [x]
    h = x
    n_layers = len(params) // 2
    for k in range(n_layers):
        h = h @ params[2 * k] + params[2 * k + 1]
        if k < n_layers - 1:
            h = np.maximum(h, 0.0)
        acts.append(h)
    return acts


def _grads(params, x, y):
    acts = _forward(params, x)
    n = len(x)
    delta = (acts[-1][:, 0] - y)[:, None] / n
    grads = [None] * len(params)
    for k in range(len(params) // 2 - 1, -1, -1):
        grads[2 * k] = acts[k].T @ delta
        grads[2 * k + 1] = delta.sum(axis=0)
        if k > 0:
            delta = (delta @ params[2 * k].T) * (acts[k] > 0)
    return grads


def _pack(batches):
    """The rows of a partition as one row of arrays."""
    frames = [b for b in batches if len(b)]
    if frames:
        pdf = pd.concat(frames)
        x = np.ascontiguousarray(pdf[FEATURES].to_numpy(dtype=float))
        yield pd.DataFrame([{"n": len(pdf), "x": x.tobytes(), "y": pdf["__y"].to_numpy(dtype=float).tobytes(),
                             "val": pdf["__val"].to_numpy(dtype=bool).tobytes()}])


def _unpack(row):
    return (np.frombuffer(row["x"]).reshape(row["n"], -1), np.frombuffer(row["y"]), np.frombuffer(row["val"], bool))


class MLPRegressorModel:
    """A fitted network plus its frozen scaling; ``predict`` runs the forward pass on Arrow batches."""

    def __init__(self, layers, vec, scaling):
        self.layers, self.vec, self.scaling = layers, vec, scaling

    def predict(self, df: DataFrame) -> DataFrame:
        feats = _with_features(df, self.scaling)
        bvec = df.sparkSession.sparkContext.broadcast(self.vec)
        layers = self.layers
        schema = T.StructType([*feats.schema.fields, T.StructField("prediction", T.DoubleType())])

        def run(batches):
            params = _unflat(bvec.value, layers)
            for pdf in batches:
                x = pdf[FEATURES].to_numpy(dtype=float)
                pdf["prediction"] = _forward(params, x)[-1][:, 0] if len(pdf) else []
                yield pdf

        return feats.mapInPandas(run, schema).drop(*FEATURES)

    @property
    def n_params(self):
        return int(sum(a * b for a, b in zip(self.layers[:-1], self.layers[1:])))


def fit_mlp_regressor(train: DataFrame, hidden=(128, 64, 32), lr: float = 1e-3, batch: int = 200,
                      max_epochs: int = 1000, patience: int = 20, val_share: float = 0.15, seed: int = SEED,
                      target: str = TARGET_REG, key: str = KEY) -> tuple[MLPRegressorModel, float, list]:
    """Fit; returns (model, seconds, validation loss history)."""
    t0 = time.time()
    spark = train.sparkSession
    scaling = fit_scaling(train)
    layers = [len(FEATURES), *hidden, 1]
    data = (_with_features(train, scaling)
            .select(*FEATURES, F.col(target).cast("double").alias("__y"),
                    (hash_unit(key, seed + 7) < F.lit(val_share)).alias("__val"))
            .mapInPandas(_pack, "n long, x binary, y binary, val binary").rdd.map(_unpack)
            .persist(StorageLevel.MEMORY_AND_DISK))  # an epoch reads arrays, not the plan of the campaigns
    vec = _flat(_init(layers, seed))
    best, best_vec, since, history = np.inf, vec, 0, []
    for epoch in range(max_epochs):
        bvec = spark.sparkContext.broadcast(vec)
        ep_seed = seed * 1000 + epoch

        def local_epoch(blocks):
            """Sums over the partition: parameters times rows, rows, squared validation error, validation rows."""
            params = _unflat(bvec.value, layers)
            for xs, ys, val in blocks:
                sse = 0.0
                if val.any():  # validation loss of the weights this epoch starts from
                    sse = float(((_forward(params, xs[val])[-1][:, 0] - ys[val]) ** 2).sum())
                x, y = xs[~val], ys[~val]
                w = float(len(x))
                rng = np.random.default_rng(ep_seed + len(x))
                m = [np.zeros_like(p) for p in params]
                v = [np.zeros_like(p) for p in params]
                step = 0
                order = rng.permutation(len(x))
                for s in range(0, len(x), batch):
                    sel = order[s:s + batch]
                    g = _grads(params, x[sel], y[sel])
                    step += 1
                    for k in range(len(params)):
                        m[k] = 0.9 * m[k] + 0.1 * g[k]
                        v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                        mh, vh = m[k] / (1 - 0.9 ** step), v[k] / (1 - 0.999 ** step)
                        params[k] = params[k] - lr * mh / (np.sqrt(vh) + 1e-8)
                yield np.concatenate([_flat(params) * w, [w, sse, float(val.sum())]])

        nothing = np.zeros(len(vec) + 3)
        sums = data.mapPartitions(local_epoch).treeAggregate(nothing, np.add, np.add, depth=2)
        bvec.unpersist()
        total = sums[-3]
        if total <= 0:
            break
        val_loss = sums[-2] / max(sums[-1], 1.0)
        history.append(val_loss)
        if val_loss < best - 1e-4 * abs(best if np.isfinite(best) else 1.0):
            best, best_vec, since = val_loss, vec, 0
        else:
            since += 1
            if since >= patience:
                break
        vec = sums[:-3] / total
    data.unpersist()
    return MLPRegressorModel(layers, best_vec, scaling), round(time.time() - t0, 3), history


# ---------------------------------------------------------------- K5: the classifier

CHUNK = 1_024  # rows multiplied at once, so that a layer's outputs stay in the cache
FEW = 64       # partitions whose sums reach the driver uncombined
MEMORY, PAST, TRIES = 10, 20, 10  # fixed values of Spark and Breeze: pairs kept, losses looked back on, steps of a line search


def _cross_entropy(params, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Cross entropy of a sigmoid network with softmax at its end, and its gradient, both summed over the rows."""
    acts, last = [x], len(params) // 2 - 1
    with np.errstate(over="ignore"):
        for k in range(last + 1):
            z = acts[-1] @ params[2 * k]
            z += params[2 * k + 1]
            if k < last:
                np.negative(z, out=z)
                np.exp(z, out=z)
                z += 1.0
                np.reciprocal(z, out=z)
            acts.append(z)
    z = acts.pop()
    z -= z.max(axis=1, keepdims=True)
    rows = np.arange(len(y))
    told = z[rows, y].sum(dtype=float)
    np.exp(z, out=z)
    total = z.sum(axis=1, keepdims=True)
    delta = z / total
    delta[rows, y] -= 1.0
    grads = [None] * len(params)
    for k in range(last, -1, -1):
        grads[2 * k], grads[2 * k + 1] = acts[k].T @ delta, delta.sum(axis=0)
        if k:
            delta = delta @ params[2 * k].T
            delta *= acts[k]
            np.subtract(1.0, acts[k], out=acts[k])
            delta *= acts[k]
    return float(np.log(total).sum(dtype=float) - told), grads


class SearchFailed(Exception):
    """No step along a direction is good enough."""


def _between(a, b) -> float:
    """The minimum of the cubic through two points (step, value, slope), away from both."""
    low, high = (b, a) if a[0] > b[0] else (a, b)
    d1 = low[2] + high[2] - 3 * (low[1] - high[1]) / (low[0] - high[0])
    with np.errstate(invalid="ignore", divide="ignore"):
        d2 = np.sqrt(np.float64(d1 * d1 - low[2] * high[2]))
        t = high[0] - (high[0] - low[0]) * (high[2] + d2 - d1) / (high[2] - low[2] + 2 * d2)
    ends = [low[0] + share * (high[0] - low[0]) for share in (0.1, 0.9)]
    return ends[0] if t < ends[0] else ends[1] if t > ends[1] else float(t)


def wolfe_step(phi, step: float) -> float:
    """A step that meets the strong Wolfe conditions; ``phi`` gives value and slope at a step."""
    _, start, slope = low = (0.0, *phi(0.0))
    if slope > 0:
        raise SearchFailed("not a descent")

    def too_high(c):
        return c[1] > start + 1e-4 * c[0] * slope

    def zoom(low, high):
        for _ in range(TRIES):
            t = _between(low, high)
            c = (t, *phi(t))
            if too_high(c) or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return t
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed("no step between")

    for i in range(TRIES):
        c = (step, *phi(step))
        if not np.isfinite(c[1]):
            step /= 2.0
            continue
        if too_high(c) or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(slope):
            return step
        if c[2] >= 0:
            return zoom(c, low)
        low, step = c, step * 1.5
    raise SearchFailed("no step")


def _direction(g: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient times the inverse Hessian as the last pairs of steps and gradient changes (latest first) tell it."""
    d, kept = g.copy(), []
    scale = pairs[0][0].dot(pairs[0][1]) / pairs[0][1].dot(pairs[0][1]) if pairs else 1.0
    if scale < 0 or np.isnan(scale):
        raise SearchFailed("no curvature")
    for s, y in pairs:
        r = s.dot(y)
        kept.append((s.dot(d) / r, r))
        if np.isnan(kept[-1][0]):
            raise SearchFailed("no curvature")
        d -= kept[-1][0] * y
    d *= scale
    for (s, y), (a, r) in zip(reversed(pairs), reversed(kept)):
        d += (a - y.dot(d) / r) * s
    return -d


def lbfgs(cost, x: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """Minimise ``cost`` (value, gradient); returns the weights and the values from the first on.

    It stops after ``max_iter`` steps, when the value is within ``tol`` times the first of the largest of the last ``PAST``,
    when the gradient is within ``tol`` times the value, or when two searches in succession fail."""
    known: dict = {}

    def at(point):  # the search ends where it has just been
        if known.get("at") is not point:
            known.update(at=point, found=cost(point))
        return known["found"]

    f, g = at(x)
    values, past, pairs, failed = [f], [np.inf], [], False
    while len(values) <= max_iter and np.linalg.norm(g) > max(tol * f, 1e-8):
        if len(past) >= 2 and abs(f - max(past)) <= tol * values[0]:
            break
        points = {0.0: x}

        def phi(t):
            value, grad = (f, g) if t == 0.0 else at(points.setdefault(t, x + t * d))
            return value, grad.dot(d)

        try:
            d = _direction(g, pairs)
            step = wolfe_step(phi, 1.0 / np.linalg.norm(d) if len(values) == 1 else 1.0)
            if step * np.linalg.norm(g) < 1e-10:
                raise SearchFailed("a step of nothing")
        except SearchFailed:
            if failed:
                break
            failed, pairs = True, []
            continue
        failed, point = False, points[step]
        value, grad = at(point)
        pairs = [(point - x, grad - g), *pairs][:MEMORY]
        x, f, g = point, value, grad
        values.append(f)
        past = [*past, f][-PAST:]
    return x, values


def first_weights(spark, est) -> np.ndarray:
    """The weights that Spark's fit starts from."""
    if est.isDefined(est.initialWeights):
        return np.array(est.getInitialWeights().toArray())
    sc = spark.sparkContext
    sizes = sc._gateway.new_array(sc._jvm.int, len(est.getLayers()))
    for i, n in enumerate(est.getLayers()):
        sizes[i] = n
    network = sc._jvm.org.apache.spark.ml.ann.FeedForwardTopology.multiLayerPerceptron(sizes, True)
    return np.array(list(network.model(est.getSeed()).weights().toArray()))


def fit_mlp_classifier(data: DataFrame, est) -> MultilayerPerceptronClassificationModel:
    """The fitted model of a ``MultilayerPerceptronClassifier`` with solver l-bfgs and the estimator's settings."""
    spark = data.sparkSession
    best, _ = mlp_weights(data, est)
    own = spark._jvm.org.apache.spark.ml.classification.MultilayerPerceptronClassificationModel(
        est.uid, _py2java(spark.sparkContext, Vectors.dense(best)))
    model = est._copyValues(MultilayerPerceptronClassificationModel(own))
    model._transfer_params_to_java()
    return model


def mlp_weights(data: DataFrame, est) -> tuple[np.ndarray, list[float]]:
    """The weights that a fit ends with, and its losses from the first weights on."""
    spark = data.sparkSession
    sc, layers = spark.sparkContext, list(est.getLayers())

    def pack(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy()).astype(np.float32)
                yield pd.DataFrame([{"n": len(pdf), "x": x.tobytes(), "y": pdf["y"].to_numpy(np.int64).tobytes()}])

    flat = data.select(vector_to_array(est.getFeaturesCol()).alias("x"), F.col(est.getLabelCol()).cast("long").alias("y"))
    if data.rdd.getNumPartitions() < sc.defaultParallelism:
        flat = flat.repartition(sc.defaultParallelism)
    rows = (flat.mapInPandas(pack, "n long, x binary, y binary")
            .rdd.map(lambda r: (np.frombuffer(r["x"], np.float32).reshape(r["n"], -1), np.frombuffer(r["y"], np.int64)))
            .persist(StorageLevel.MEMORY_AND_DISK))
    few = rows.getNumPartitions() <= FEW

    def cost(vec):
        sent = sc.broadcast(vec)

        def add(blocks):
            params = _unflat(sent.value.astype(np.float32), layers)
            total = np.zeros(len(sent.value) + 2)
            for x, y in blocks:
                for a in range(0, len(y), CHUNK):
                    loss, grads = _cross_entropy(params, x[a:a + CHUNK], y[a:a + CHUNK])
                    total[:-2] += _flat(grads)
                    total[-2] += loss
                total[-1] += len(y)
            yield total

        sums = rows.mapPartitions(add)
        total = sums.reduce(np.add) if few else sums.treeReduce(np.add, depth=2)
        sent.unpersist()
        n = max(total[-1], 1.0)
        return total[-2] / n, total[:-2] / n

    found = lbfgs(cost, first_weights(spark, est), est.getMaxIter(), est.getTol())
    rows.unpersist()
    return found
