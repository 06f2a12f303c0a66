"""Linear classifiers of every pair of labels, and their vote."""

from __future__ import annotations

from itertools import combinations
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARALLELISM = 3  # machines that are fitted at a time


class OneVsOneSVM(Estimator):
    """A linear support vector machine for each pair of labels.

    Every machine sees the rows of its two labels only.  ``C`` is the inverse penalty on the
    summed hinge loss, which makes ``1 / (C * rows)`` on the mean; zero asks for no penalty.  A row gets
    the label that most machines name; of several the smallest.  The fitted model has
    stages of Spark's own only.
    """

    C = Param(Params._dummy(), "C", "inverse penalty on the summed loss, 0 for none", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most iterations of each machine", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "vectors", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label numbers", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, C=1.0, maxIter=1000, featuresCol="features", labelCol="label"):
        super().__init__()
        self._set(C=C, maxIter=maxIter, featuresCol=featuresCol, labelCol=labelCol)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        features, label = self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol)
        C = self.getOrDefault(self.C)
        rows = dataset.select(F.col(label).cast("double").alias("_label"), F.col(features).alias("_features"))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
            labels = sorted(counts)
            pairs = list(combinations(labels, 2))

            def fit(pair: tuple[int, tuple[float, float]]) -> Model:
                number, (low, high) = pair
                machine = LinearSVC(
                    featuresCol="_features", labelCol="_side", predictionCol=f"_vote{number}", rawPredictionCol=f"_raw{number}",
                    maxIter=self.getOrDefault(self.maxIter), standardization=False,
                    regParam=1.0 / (C * (counts[low] + counts[high])) if C else 0.0,
                )
                side = F.when(F.col("_label") == high, 1.0).otherwise(0.0)
                seen = rows.filter(F.col("_label").isin(low, high)).withColumn("_side", side)
                return machine.fit(seen).setFeaturesCol(features)

            # A step of a machine is a short job, so the machines take their steps side by side.
            pool = ThreadPool(max(1, min(PARALLELISM, len(pairs))))
            try:
                machines = pool.map(inheritable_thread_target(dataset.sparkSession)(fit), enumerate(pairs))
            finally:
                pool.close()
            votes = {name: ["0"] for name in labels}
            for number, (low, high) in enumerate(pairs):
                votes[low].append(f"int(_vote{number} = 0)")
                votes[high].append(f"int(_vote{number} = 1)")
        finally:
            rows.unpersist()
        sums = ", ".join(" + ".join(votes[name]) for name in labels)
        names = ", ".join(f"{name}D" for name in labels)
        chosen = f"element_at(array({names}), int(array_position(_votes, array_max(_votes))))" if labels else "NULL"
        made = ", ".join([f"_vote{i}, _raw{i}" for i in range(len(machines))] + ["_votes"])
        return PipelineModel(
            [
                *machines,
                SQLTransformer(statement=f"SELECT *, array({sums}) AS _votes FROM __THIS__"),
                SQLTransformer(statement=f"SELECT *, {chosen} AS prediction FROM __THIS__"),
                SQLTransformer(statement=f"SELECT * EXCEPT ({made}) FROM __THIS__"),
            ]
        )
