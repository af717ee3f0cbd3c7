"""Spark ML models: user segmentation (KMeans sweep), annotation model, forest ranker."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.evaluate import multiclass_metrics
from shoplens.operators.kmeans import assign, best_of, fit_many
from shoplens.operators.segments import assign_segment_names, davies_bouldin, segment_summary, silhouette
from shoplens.operators.similarity import moments, standardize
from shoplens.operators.split import stratified_split
from shoplens.schema import ITEM_CATEGORICAL_FEATURES, PROFILE_FEATURES, RANKER_NUMERIC
from shoplens.session import materialize, trace


@dataclass
class SegmentArtifacts:
    clustered: DataFrame          # profiles + cluster_id, pca_x, pca_y, cluster_name
    summary: DataFrame            # one row per segment, with cluster_name
    k_metrics: DataFrame          # k, silhouette, davies_bouldin
    auto_label_metrics: dict[str, float]
    profile_feature_columns: list[str]


def fit_user_segments(profiles: DataFrame, k_values: Iterable[int] = range(2, 7), seed: int = 42,
                      n_init: int = 20, max_iter: int = 300, euclidean: bool = False) -> SegmentArtifacts:
    """KMeans for each k (best of ``n_init`` starts by cost, all moved together), silhouette /
    Davies-Bouldin on all users, keep the k with the strictly largest silhouette, then PCA(2),
    segment names and a logistic-regression annotation check.

    The silhouette is the squared Euclidean one, linear in the users; ``euclidean`` takes
    the Euclidean one, which compares all pairs of distinct users."""
    feats = list(PROFILE_FEATURES)
    scaled = standardize(profiles, feats, keep=("user_id",), ddof=0).select("user_id", F.array(*feats).alias("fv"))
    scaled = materialize(profiles.join(scaled, "user_id").withColumn("features", array_to_vector("fv")), "segment-input")
    ks = list(k_values)
    fitted = best_of(fit_many(scaled, "fv", "user_id", ks, n_init, seed, max_iter))
    trace("segments: all fits done")

    def score(k):
        pred = assign(scaled, "fv", fitted[k].centres).select("user_id", "cluster_id", "fv", "features")
        if euclidean:
            s_val = silhouette(pred, "user_id", "cluster_id", "fv").first()["silhouette"]
        else:
            s_val = ClusteringEvaluator(predictionCol="cluster_id", featuresCol="features", metricName="silhouette",
                                        distanceMeasure="squaredEuclidean").evaluate(pred)
        return float(s_val), float(davies_bouldin(pred, "cluster_id", "fv").first()["davies_bouldin"])

    with ThreadPoolExecutor(max_workers=max(1, min(len(ks), 8))) as pool:
        scores = dict(zip(ks, pool.map(score, ks)))
    trace("segments: all k scored")
    rows = [(int(k), *scores[k]) for k in ks]
    best_k = None
    for k, s_val, _ in rows:
        if best_k is None or s_val > scores[best_k][0]:   # strictly larger silhouette, in k order
            best_k = k
    if best_k is None:
        raise ValueError("no k to choose from")
    clustered = assign(scaled, "fv", fitted[best_k].centres)
    pca = PCA(k=2, inputCol="features", outputCol="_pca").fit(clustered)
    clustered = pca.transform(clustered).select(
        *profiles.columns, F.col("cluster_id").cast("int"),
        vector_to_array("_pca")[0].alias("pca_x"), vector_to_array("_pca")[1].alias("pca_y"), "features")
    clustered = materialize(clustered, "segments")
    summary = assign_segment_names(segment_summary(clustered)).orderBy("cluster_id")
    # at most max(k_values) segment rows
    clustered = clustered.join(F.broadcast(summary.select("cluster_id", "cluster_name")), "cluster_id", "left")
    trace("segments: named")
    metrics = annotation_metrics(clustered, feats, seed)
    trace("segments: annotation model")
    metrics["best_k"] = float(best_k)
    k_metrics = profiles.sparkSession.createDataFrame(rows, "k int, silhouette double, davies_bouldin double")
    return SegmentArtifacts(clustered.drop("features"), summary, k_metrics, metrics, feats)


def annotation_metrics(clustered: DataFrame, feats: Sequence[str], seed: int = 42) -> dict[str, float]:
    """75/25 split stratified by segment; scaler + multinomial logistic regression;
    accuracy and macro F1 on the held-out quarter."""
    s = stratified_split(clustered.select("user_id", "cluster_id", *feats), "cluster_id", ["user_id"], seed,
                         test_size=0.25, val_size=0.0)
    train = s.where(F.col("split") != "test")
    test = s.where(F.col("split") == "test")
    n_train = train.count()
    means, stds, _ = moments(train, list(feats), ddof=0)        # of the training rows, for both parts

    def scaled(df: DataFrame) -> DataFrame:
        x = F.array(*[(F.col(c).cast("double") - F.lit(means[c])) / F.lit(stds[c]) for c in feats])
        return df.select(F.col("cluster_id").cast("double").alias("cluster_id"), array_to_vector(x).alias("_x"))

    # maxIter 300 and tolerance 1e-4 as in the reference's solver settings
    lr = LogisticRegression(featuresCol="_x", labelCol="cluster_id", maxIter=300, tol=1e-4, family="multinomial",
                            regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False).fit(scaled(train))
    pred = lr.transform(scaled(test)).select(F.col("cluster_id").cast("int").alias("y"),
                                     F.col("prediction").cast("int").alias("p"))
    m = multiclass_metrics(pred, "y", "p").first()
    return {"annotation_accuracy": float(m["accuracy"] or 0.0), "annotation_f1_macro": float(m["f1_macro"] or 0.0)}


def class_weight_column(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Balanced class weights n / (2 * n_class) as a column (global, not per bootstrap)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    n_classes = counts.count()
    total = F.sum("_nc").over(Window.partitionBy(F.lit(1)))  # one row per class
    w = counts.select(label_col, (total.cast("double") / (F.lit(float(n_classes)) * F.col("_nc"))).alias("_w"))
    return df.join(w, label_col, "left")  # one row per class; AQE broadcasts it by measured size


@dataclass
class RankerArtifacts:
    model: PipelineModel
    feature_names: list[str]


class RandomForestRanker:
    """Forest over the ranker columns: 120 trees, depth 5, >= 15 rows per leaf, balanced weights.

    Trees do not need scaling; the category is one-hot encoded with a column per
    known category and all zeros for an unseen one."""

    def __init__(self, seed: int = 42, num_trees: int = 120, max_depth: int = 5, min_leaf: int = 15):
        self.seed, self.num_trees, self.max_depth, self.min_leaf = seed, num_trees, max_depth, min_leaf
        self.numeric = list(RANKER_NUMERIC)
        self.categorical = ITEM_CATEGORICAL_FEATURES[0]

    def _prep(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[F.col(c).cast("double").alias(f"_n_{c}") for c in self.numeric])

    def fit(self, df: DataFrame) -> RankerArtifacts:
        data = class_weight_column(self._prep(df).withColumn("_y", F.col("label").cast("double")), "label")
        stages = [
            StringIndexer(inputCol=self.categorical, outputCol="_cat_idx", handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=["_cat_idx"], outputCols=["_cat_vec"], dropLast=True),
            VectorAssembler(inputCols=[f"_n_{c}" for c in self.numeric] + ["_cat_vec"], outputCol="_x"),
            RandomForestClassifier(featuresCol="_x", labelCol="_y", weightCol="_w", numTrees=self.num_trees,
                                   maxDepth=self.max_depth, minInstancesPerNode=self.min_leaf,
                                   featureSubsetStrategy="sqrt", seed=self.seed),
        ]
        model = Pipeline(stages=stages).fit(data)
        labels = model.stages[0].labels
        names = self.numeric + [f"{self.categorical}_{v}" for v in labels]
        return RankerArtifacts(model, names)

    def predict(self, art: RankerArtifacts, df: DataFrame, out_col: str = "rf_score") -> DataFrame:
        cols = df.columns
        out = art.model.transform(self._prep(df))
        return out.select(*cols, vector_to_array("probability")[1].alias(out_col))

    @staticmethod
    def feature_importance(art: RankerArtifacts) -> list[tuple[str, float]]:
        imp = art.model.stages[-1].featureImportances.toArray()
        pairs = list(zip(art.feature_names, [float(x) for x in imp]))
        return sorted(pairs, key=lambda p: -p[1])
