"""Feature vectors, scaling, k-means and its quality, on Spark ML."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURES
from ..sources.shared import stored

# Cluster count and seed of the reported clustering.
CLUSTERS = 3
SEED = 42
SWEEP = tuple(range(2, 10))

# Partitions while fitting: one for so many accounts, and so many at least. The first
# centres are drawn by partition, so their number is part of what decides a clustering; it
# follows from the accounts alone.
FIT_ROWS = 1_000_000
FIT_PARTITIONS = 8


def fit_partitions(rows: int) -> int:
    return max(FIT_PARTITIONS, -(-rows // FIT_ROWS))


def feature_vectors(
    metrics: DataFrame, features: Sequence[str] = FEATURES, *, handle_invalid: str = "error"
) -> DataFrame:
    """Add the vector ``features``. A null feature fails the job by default;
    ``handle_invalid="skip"`` leaves such accounts out."""
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=handle_invalid
    )
    return assembler.transform(metrics)


def fit_scaler(vectors: DataFrame) -> StandardScalerModel:
    return StandardScaler(inputCol="features", outputCol="scaled_features").fit(vectors)


def scaled_features(vectors: DataFrame) -> DataFrame:
    """Add ``scaled_features``: unit standard deviation, not centred."""
    return fit_scaler(vectors).transform(vectors)


def unpack_vector(df: DataFrame, vector: str, names: Sequence[str] = FEATURES) -> DataFrame:
    """Replace a vector column by one double column per element."""
    values = vector_to_array(F.col(vector))
    others = [c for c in df.columns if c != vector and c not in set(names)]
    return df.select(*others, *[values[i].alias(name) for i, name in enumerate(names)])


def in_order(df: DataFrame, key: str = "screen_name", partitions: int | None = None) -> DataFrame:
    """The frame in a layout that only its content decides: partitions by key, sorted. By
    default their number follows the rows, which are counted for it."""
    if partitions is None:
        partitions = fit_partitions(df.count())
    return df.repartition(partitions, key).sortWithinPartitions(key)


def fit_clusters(
    scaled: DataFrame,
    k: int = CLUSTERS,
    seed: int | None = SEED,
    *,
    key: str = "screen_name",
    partitions: int | None = None,
) -> KMeansModel:
    """Fit on a fixed layout: the choice of first centres goes by partition, so
    only then does the seed decide it."""
    kmeans = KMeans(k=k, featuresCol="scaled_features", predictionCol="cluster")
    if seed is not None:
        kmeans = kmeans.setSeed(seed)
    return kmeans.fit(in_order(scaled.select(key, "scaled_features"), key, partitions))


def _distinct(scaled: DataFrame, most: int) -> int:
    """Number of distinct vectors, at most ``most``: k-means cannot give more clusters."""
    return scaled.select("scaled_features").distinct().limit(most).count()


def assign_clusters(
    scaled: DataFrame, k: int = CLUSTERS, seed: int | None = SEED, partitions: int | None = None
) -> DataFrame:
    """Add the k-means cluster of every account. Fewer than ``k`` distinct accounts give
    one cluster each."""
    k = min(k, _distinct(scaled, k))
    if k < 2:
        return scaled.withColumn("cluster", F.lit(0))
    return fit_clusters(scaled, k, seed, partitions=partitions).transform(scaled)


def account_clusters(clustered: DataFrame) -> DataFrame:
    """Predictions table: metrics and cluster, without the vectors."""
    return clustered.drop("features", "scaled_features")


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"))


def silhouette(clustered: DataFrame, distance: str = "cosine") -> float | None:
    """Mean silhouette; None for fewer than two clusters."""
    if clustered.select("cluster").distinct().limit(2).count() < 2:
        return None
    evaluator = ClusteringEvaluator(
        featuresCol="scaled_features",
        predictionCol="cluster",
        metricName="silhouette",
        distanceMeasure=distance,
    )
    return evaluator.evaluate(clustered)


def cluster_silhouette(clustered: DataFrame, distance: str = "cosine") -> DataFrame:
    """One row with the silhouette."""
    score = silhouette(clustered, distance)
    return clustered.sparkSession.createDataFrame([(score,)], "silhouette double")


def silhouettes(df: DataFrame, clusters: Sequence[str], distance: str = "squaredEuclidean") -> DataFrame:
    """Per column of cluster numbers in ``clusters``: name, number of clusters and mean
    silhouette (null below two clusters) of the vectors ``scaled_features``.

    All columns are evaluated together, in two passes over the frame however many they
    are: one adds up count, vectors and squared lengths per column and cluster, which is
    all that mean squared distances to a cluster need; one averages the silhouettes. Only
    those sums, a vector for each cluster of each column, pass through the driver. The
    cosine distance is the squared one of vectors of length 1, halved.
    """
    if distance not in ("squaredEuclidean", "cosine"):
        raise ValueError(f"distance is squaredEuclidean or cosine, not {distance}")
    names = list(clusters)
    values = vector_to_array(F.col("scaled_features"))
    narrow = df.select(values.alias("x"), F.array(*[F.col(f"`{n}`").cast("int") for n in names]).alias("c"))
    unit = distance == "cosine"

    def vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        if unit:
            length = np.sqrt((x * x).sum(1, keepdims=True))
            x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
        return x, batch.column("c").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, c = vectors(batch)
            row = np.column_stack([np.ones(len(x)), (x * x).sum(1), x])
            for j in range(c.shape[1]):
                for cluster in np.unique(c[:, j]):
                    part = row[c[:, j] == cluster].sum(0)
                    key = (j, int(cluster))
                    totals[key] = totals[key] + part if key in totals else part
        keys = list(totals)
        yield pa.RecordBatch.from_pydict(
            {"column": pa.array([k[0] for k in keys], pa.int32()), "cluster": pa.array([k[1] for k in keys], pa.int32()),
             "sums": pa.array([totals[k].tolist() for k in keys], pa.list_(pa.float64()))}
        )

    parts = narrow.mapInArrow(add_up, "column int, cluster int, sums array<double>")
    parts = parts.select("column", "cluster", F.posexplode("sums").alias("i", "part"))
    sums = parts.groupBy("column", "cluster", "i").agg(F.sum("part").alias("part")).groupBy("column", "cluster").agg(
        F.array_sort(F.collect_list(F.struct("i", "part"))).getField("part").alias("sums")
    )
    found: dict[int, dict[int, np.ndarray]] = {j: {} for j in range(len(names))}
    for row in sums.collect():
        found[row["column"]][row["cluster"]] = np.array(row["sums"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(len(names)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, c = vectors(batch)
            for j, of in found.items():
                if len(of) > 1:
                    total[j] += _silhouette_sum(x, c[:, j], of)
            count += len(x)
        yield pa.RecordBatch.from_pydict(
            {"column": pa.array(range(len(names)), pa.int32()), "total": total, "count": [count] * len(names)}
        )

    scored = narrow.mapInArrow(score, "column int, total double, count bigint")
    means = {
        row["column"]: row["mean"]
        for row in scored.groupBy("column").agg((F.sum("total") / F.sum("count")).alias("mean")).collect()
    } if any(found.values()) else {}
    rows = [(name, len(found[j]), means.get(j) if len(found[j]) > 1 else None) for j, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "name string, clusters int, silhouette double")


def _silhouette_sum(x: np.ndarray, own: np.ndarray, of: dict[int, np.ndarray]) -> float:
    """Sum of the silhouettes of vectors, given count, squared lengths and sum of the
    vectors of every cluster."""
    numbers = np.array(sorted(of))
    sums = np.stack([of[n] for n in numbers])
    size, squares, total = sums[:, 0], sums[:, 1], sums[:, 2:]
    away = (x * x).sum(1)[:, None] + squares / size - 2 * x @ (total / size[:, None]).T
    at = np.searchsorted(numbers, own)
    every = np.arange(len(x))
    mates = size[at]
    with np.errstate(divide="ignore", invalid="ignore"):
        inside = away[every, at] * mates / (mates - 1)
        away[every, at] = np.inf
        outside = away.min(1)
        value = np.where(inside < outside, 1 - inside / outside, np.where(inside > outside, outside / inside - 1, 0.0))
    return float(np.where(mates == 1, 0.0, value).sum())


def k_sweep(
    scaled: DataFrame,
    ks: Iterable[int] = SWEEP,
    *,
    key: str = "screen_name",
    seed: int | None = None,
    distance: str = "squaredEuclidean",
    partitions: int | None = None,
) -> DataFrame:
    """Clusters found and silhouette for every cluster count; null where there are fewer
    distinct accounts than that. The vectors are laid out and stored once; every fit reads
    that table, and all fits are evaluated in the same two passes."""
    ks = list(ks)
    laid = stored(in_order(stored(scaled.select(key, "scaled_features")), key, partitions))
    most, clustered = _distinct(laid, max(ks)), laid
    fitted = [k for k in dict.fromkeys(ks) if 2 <= k <= most]
    for k in fitted:
        model = KMeans(k=k, featuresCol="scaled_features", predictionCol=f"k{k}")
        clustered = (model if seed is None else model.setSeed(seed)).fit(laid).transform(clustered)
    scores = {}
    if fitted:
        for row in silhouettes(clustered, [f"k{k}" for k in fitted], distance).collect():
            scores[int(row["name"][1:])] = (row["clusters"], row["silhouette"])
    rows = [(k, *scores.get(k, (None, None))) for k in ks]
    return scaled.sparkSession.createDataFrame(rows, "k int, clusters int, silhouette double")
