"""Model-based detectors: k-means clustering and an isolation forest.

Neither depends on how rows are partitioned: sums that steer the fit are exact
integers, and rows are sampled by a hash of their features and their number.
Both run jobs while they are built.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsift.operators.analytics import discrete_quantiles
from logsift.session import persist

# ---------------------------------------------------------------- k-means

# Scaled features are summed as integers of this many parts of a unit.
_PARTS = 1_000_000


def kmeans_clusters(df: DataFrame, feature_cols=("request_count", "response_time"), k: int = 2,
                    max_iter: int = 20, tol: float = 1e-4, rare_share: float = 0.05,
                    distance_sigmas: float = 3.0) -> DataFrame:
    """Scaled k-means over the feature columns (Lloyd's iterations).

    Adds ``features``, ``scaled_features`` (divided by the column stddev, not
    centred), ``cluster``, ``centre_distances``, ``distance`` to the nearest
    centre, ``cluster_size``, and ``cluster_anomaly`` (1 for rows of a cluster
    holding less than ``rare_share`` of the rows, or farther from their centre
    than mean + ``distance_sigmas`` stddev of their cluster's distances). Rows
    with a NULL or NaN feature are left out, since they have no position.

    The first centres are the (i + 0.5) / k quantiles of every feature, and a
    centre is the mean of its rows in integer parts, so equal rows give equal
    clusters whatever their partitions. Equal positions are counted once and
    written; each iteration is one aggregation of them to k rows, with the
    distances as plain expressions.
    """
    cols = list(feature_cols)
    data = persist(df.filter(~_missing(cols)), "kmeans-input")
    stats = data.agg(F.count(F.lit(1)), *[F.stddev(F.col(c).cast("double")) for c in cols]).first()
    total = stats[0]
    # Rounded to nine digits: the order of summation shows in the last ones.
    scale = [float(f"{s:.9g}") if s else 0.0 for s in stats[1:]]
    starts = discrete_quantiles(data, {c: [(i + 0.5) / k for i in range(k)] for c in cols})
    first = data.sparkSession.range(1).select(*[v.cast("double") for c in cols for v in starts[c]]).first()
    features = F.array(*[F.col(c).cast("double") for c in cols])
    scaled = F.array(*[(F.col(c).cast("double") / s if s else F.lit(0.0)) for c, s in zip(cols, scale)])
    data = data.withColumn("features", features).withColumn("scaled_features", scaled)
    centres = np.zeros((k, len(cols)))
    if total:
        for j, s in enumerate(scale):
            centres[:, j] = [(v / s if s else 0.0) for v in first[j * k:(j + 1) * k]]
    places = [f"_x{j}" for j in range(len(cols))]
    points = data.select(*[F.col("scaled_features")[j].alias(x) for j, x in enumerate(places)]).groupBy(*places).agg(F.count(F.lit(1)).alias("_n"))
    points = persist(points, "kmeans-points") if total else points
    for _ in range(max_iter if total else 0):
        part = [F.sum(F.round(F.col(x) * _PARTS).cast("decimal(20,0)") * F.col("_n")) for x in places]
        away = _distances([F.col(x) for x in places], centres)
        rows = points.groupBy(_first_least(away).alias("cluster")).agg(F.sum("_n"), *part).collect()  # at most k rows
        moved = centres.copy()
        for r in rows:
            moved[r[0]] = [float(x) / r[1] / _PARTS for x in r[2:]]
        shift = float(np.abs(moved - centres).max())
        centres = moved
        if shift <= tol:
            break
    out = _nearest(data, centres)
    spread = out.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"), F.avg("distance").alias("_mean"),
                                        F.stddev("distance").alias("_std"))
    out = out.join(F.broadcast(spread), "cluster", "left")  # k rows
    far = F.col("distance") > F.col("_mean") + distance_sigmas * F.coalesce(F.col("_std"), F.lit(0.0))
    rare = F.col("cluster_size") < rare_share * total
    return out.withColumn("cluster_anomaly", F.when(rare | far, 1).otherwise(0)).drop("_mean", "_std")


def _distances(position: list, centres: np.ndarray) -> list:
    """Distance of a position from every centre."""
    def away(centre):
        squares = [(x - float(c)) * (x - float(c)) for x, c in zip(position, centre)]
        return F.sqrt(sum(squares[1:], squares[0]))

    return [away(c) for c in centres]


def _first_least(distances: list):
    """Index of the least distance, the first of equal ones."""
    least = F.least(*distances) if len(distances) > 1 else distances[0]
    return F.coalesce(*[F.when(d == least, F.lit(i)) for i, d in enumerate(distances)]).cast("int")


def _nearest(data: DataFrame, centres: np.ndarray) -> DataFrame:
    """``centre_distances``, ``distance`` and ``cluster``: the nearest centre, the first of equally near ones."""
    position = [F.col("scaled_features")[j] for j in range(centres.shape[1])]
    step = data.withColumn("centre_distances", F.array(*_distances(position, centres)))
    own = [F.col("centre_distances")[i] for i in range(len(centres))]
    step = step.withColumn("distance", F.least(*own) if len(own) > 1 else own[0])
    return step.withColumn("cluster", _first_least(own))


def kmeans_check(clusters: DataFrame) -> DataFrame:
    """One row: rows, sum of the cluster sizes, rows that do not sit at their nearest centre."""
    per = clusters.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.max("cluster_size").alias("size"),
        F.count_if(F.col("distance") > F.array_min("centre_distances")).alias("off"))
    return per.agg(F.sum("n").alias("n_rows"), F.sum("size").alias("size_sum"), F.sum("off").alias("misplaced"))


def _missing(cols):
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return out


# ------------------------------------------------------- isolation forest

_EULER = 0.5772156649015329


def _c(n):
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + _EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _build_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Isolation tree as flat arrays: feature, threshold, left, right, size (leaf: left = -1)."""
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx, depth):
        i = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return i
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return i
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < t
        feat[i], thr[i] = f, t
        left[i] = node(idx[go_left], depth + 1)
        right[i] = node(idx[~go_left], depth + 1)
        return i

    node(np.arange(len(x)), 0)
    return feat, thr, left, right, size


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()),
])


def _tree_builder(n_features: int, psi: int, seed: int):
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    names = [f"f{i}" for i in range(n_features)]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        # Keep the psi draws of lowest hash: a uniform sample of fixed size.
        pdf = pdf.sort_values(["_h", *names], kind="mergesort").head(psi)
        x = pdf[names].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        feat, thr, left, right, size = _build_tree(x, rng, max_depth)
        return pd.DataFrame({
            "tree": np.int32(tree), "node": np.arange(len(feat), dtype=np.int32),
            "feature": np.asarray(feat, dtype=np.int32), "threshold": np.asarray(thr, dtype=float),
            "left": np.asarray(left, dtype=np.int32), "right": np.asarray(right, dtype=np.int32),
            "size": np.asarray(size, dtype=np.int64),
        })

    return build


def _forest_arrays(nodes: pd.DataFrame, n_trees: int):
    """Pack node rows into padded [tree, node] arrays for vectorised scoring."""
    width = int(nodes["node"].max()) + 1
    shape = (n_trees, width)
    feat = np.full(shape, -1, dtype=np.int64)
    thr = np.zeros(shape)
    left = np.full(shape, -1, dtype=np.int64)
    right = np.full(shape, -1, dtype=np.int64)
    size = np.ones(shape)
    t, n = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    feat[t, n] = nodes["feature"].to_numpy()
    thr[t, n] = nodes["threshold"].to_numpy()
    left[t, n] = nodes["left"].to_numpy()
    right[t, n] = nodes["right"].to_numpy()
    size[t, n] = nodes["size"].to_numpy()
    return feat, thr, left, right, size


def _path_lengths(x: np.ndarray, forest, max_depth: int) -> np.ndarray:
    feat, thr, left, right, size = forest
    n_trees = feat.shape[0]
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for t in range(n_trees):
        cur = np.zeros(len(x), dtype=np.int64)
        depth = np.zeros(len(x))
        for _ in range(max_depth + 1):
            f = feat[t, cur]
            inner = f >= 0
            if not inner.any():
                break
            go_left = x[rows, np.maximum(f, 0)] < thr[t, cur]
            nxt = np.where(go_left, left[t, cur], right[t, cur])
            cur = np.where(inner, nxt, cur)
            depth += inner
        total += depth + _c(size[t, cur])
    return total / n_trees


def isolation_forest(df: DataFrame, feature_cols=("request_count", "response_time"), n_trees: int = 100,
                     sample_size: int = 256, contamination: float = 0.1, seed: int = 42,
                     oversample: float = 1.5) -> DataFrame:
    """Isolation forest (Liu, Ting & Zhou 2008) over the feature columns.

    Adds ``anomaly_score`` in (0, 1] (higher = easier to isolate) and
    ``isolation_forest_anomaly`` = 1 for scores above the (1 - contamination)
    quantile of the scores. Rows with a NULL or NaN feature get NULL score and
    flag 0.

    Sampling, one rule at every size: rows with equal features are counted (which
    combines before the shuffle). Of about ``oversample`` x psi x n_trees draws
    (psi = min(sample_size, rows)) a kind of row gets its share, the fraction
    rounded up or down by a hash of its features, and a hash of features and
    draw picks each draw's tree. Every tree keeps its psi draws of lowest hash.
    So equal rows are drawn as often as others, the draws do not depend on
    partitions and are the same after a lost executor, and a tree's task gets
    about oversample x psi rows. Only the trees (at most n_trees x (2 psi - 1)
    nodes) reach the driver.
    """
    cols = list(feature_cols)
    names = [f"f{i}" for i in range(len(cols))]
    valid = ~_missing(cols)
    kinds = persist(df.filter(valid).groupBy(*[F.col(c).cast("double").alias(f) for c, f in zip(cols, names)]).agg(
        F.count(F.lit(1)).alias("_m")), "forest-rows")
    n = kinds.agg(F.sum("_m")).first()[0] or 0
    if not n:
        return df.withColumn("anomaly_score", F.lit(None).cast("double")).withColumn(
            "isolation_forest_anomaly", F.lit(0))
    psi = int(min(sample_size, n))

    def unit(*parts):
        # uniform in [0, 1) from a 64-bit hash
        return (F.xxhash64(*parts).cast("double") + F.lit(float(2 ** 63))) / F.lit(float(2 ** 64))

    share = F.col("_m") * F.lit(oversample * psi * n_trees / n)
    draws = F.floor(share + unit(F.lit(seed), *names)).cast("int")
    sampled = kinds.withColumn("_draws", draws).filter("_draws > 0").select(
        *names, F.explode(F.sequence(F.lit(1), F.col("_draws"))).alias("_draw"))
    tree = F.least(F.floor(unit(F.lit(seed + 1), *names, "_draw") * n_trees).cast("int"), F.lit(n_trees - 1))
    sampled = sampled.select(*names, tree.alias("tree"), unit(F.lit(seed + 2), *names, "_draw").alias("_h"))
    # The explicit partition count keeps trees built in parallel: the input is
    # too small for adaptive execution to keep more than one partition otherwise.
    parallel = max(1, min(n_trees, df.sparkSession.sparkContext.defaultParallelism))
    nodes = (sampled.repartition(parallel, "tree")
             .groupBy("tree")
             .applyInPandas(_tree_builder(len(cols), psi, seed), NODE_SCHEMA)
             .toPandas())
    # With few rows some trees may have got no draw.
    nodes["tree"] = pd.factorize(nodes["tree"])[0]
    forest = _forest_arrays(nodes, int(nodes["tree"].max()) + 1)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    cpsi = float(_c(np.array([psi]))[0]) or 1.0

    @F.pandas_udf(T.DoubleType())
    def score(*series: pd.Series) -> pd.Series:
        x = np.column_stack([s.to_numpy(dtype=float) for s in series])
        return pd.Series(np.power(2.0, -_path_lengths(x, forest, max_depth) / cpsi))

    # Scored once: the cut-off and the output both read the written scores
    # (scoring 100 trees per row costs more than writing the row).
    scored = persist(df.withColumn("anomaly_score", F.when(valid, score(*[F.col(c).cast("double") for c in cols]))), "forest-scores")
    (cut,) = discrete_quantiles(scored, {"anomaly_score": (1.0 - contamination,)})["anomaly_score"]
    return scored.withColumn("isolation_forest_anomaly", F.when(F.col("anomaly_score") > cut, 1).otherwise(0))


def isolation_forest_check(scored: DataFrame, contamination: float = 0.1) -> DataFrame:
    """One row: rows, rows without a score, scores outside (0, 1], and whether at
    most the contamination's share is flagged."""
    s = F.col("anomaly_score")
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(s.isNull()).alias("null_scores"),
        F.count_if((s <= 0) | (s > 1)).alias("out_of_range"),
        (F.sum("isolation_forest_anomaly") <= contamination * F.count(s)).alias("flagged_share_kept"))
