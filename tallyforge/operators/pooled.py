"""Spark's boosted trees fitted on rows that are pooled by their bins."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import boost, forest

#: Bins that Spark may take for features that are bin numbers already: enough for it to see all of up to a million points.
POINT_BINS = 1024


class Binned(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the bin numbers of a vector's features as a vector; the edges are JSON text."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector of bin numbers", TypeConverters.toString)
    edges = Param(Params._dummy(), "edges", "upper edges of the bins of every feature as JSON text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", outputCol="__bins", edges="[]"):
        super().__init__()
        self._setDefault(featuresCol="features", outputCol="__bins", edges="[]")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        edges = json.loads(self.getOrDefault("edges"))

        @F.pandas_udf("array<double>")
        def binned(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            return pd.Series(list(boost.binned_array(np.stack(vectors.to_numpy()), edges).astype(np.float64)))

        return dataset.withColumn(self.getOrDefault("outputCol"), array_to_vector(binned(vector_to_array(self.getOrDefault("featuresCol")))))


def pooled_points(df: DataFrame, features: str, label: str, held: str, edges: Sequence[Sequence[float]]) -> DataFrame:
    """(__bins, label, held, weight): rows of equal bins as two points with the number, sum and sum of squares of their labels.

    Trees see no more of the rows: splits, leaf values and squared errors are those of the rows.
    """

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.asarray(batch.column("v").flatten(), np.float64).reshape(batch.num_rows, -1)
                if not np.isfinite(values).all():
                    raise ValueError("features of boosted trees must be finite")
                yield pa.RecordBatch.from_arrays([boost.packed_matrix(boost.binned_array(values, edges)), batch.column("label"), batch.column("held")],
                                                 names=["bins", "label", "held"])

    @F.pandas_udf("array<double>")
    def unpacked(bins: pd.Series) -> pd.Series:
        return bins.map(lambda b: np.frombuffer(b, np.uint8).astype(np.float64))

    rows = df.select(vector_to_array(features).alias("v"), F.col(label).cast("double").alias("label"), F.col(held).alias("held"))
    pools = rows.mapInArrow(binned, "bins binary, label double, held boolean").groupBy("bins", "held").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("label").alias("mean"), F.stddev_pop("label").alias("apart"))
    two = F.col("apart") > 0
    labels = F.when(two, F.array(F.col("mean") - F.col("apart"), F.col("mean") + F.col("apart"))).otherwise(F.array("mean"))
    return pools.select(array_to_vector(unpacked("bins")).alias("__bins"), "held", F.when(two, F.col("n") / 2).otherwise(F.col("n")).alias("weight"),
                        F.explode(labels).alias("label"))


class PooledBoosting(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Spark's gradient boosting of squared errors over all rows, whose work in a round is bounded by the distinct bins.

    Rows of equal bins get the same prediction in every round, so they are pooled once before the rounds. With
    `validationIndicatorCol` the rows marked true are held out, pooled likewise, and Spark stops by them.
    """

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    validationIndicatorCol = Param(Params._dummy(), "validationIndicatorCol", "rows to stop by", TypeConverters.toString)
    plan = Param(Params._dummy(), "plan", "rounds, learning_rate, max_depth and seed as JSON text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", validationIndicatorCol="", plan="{}"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", validationIndicatorCol="", plan="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        features, label, mark = (self.getOrDefault(c) for c in ("featuresCol", "labelCol", "validationIndicatorCol"))
        plan = json.loads(self.getOrDefault("plan"))
        held = F.col(mark) if mark else F.lit(False)
        marked = dataset.withColumn("__held", held)
        said = marked.agg(F.count_if(~F.col("__held")).alias("rows"),
                          F.count_if(F.col(label).isNull() | F.isnan(F.col(label).cast("double"))).alias("bad")).first()
        if not said["rows"]:
            raise ValueError("no rows to fit on")
        if said["bad"]:
            raise ValueError("labels must not be null or NaN")
        edges = forest.sampled_edges(marked.where(~F.col("__held")), features, said["rows"], plan["seed"])
        points = pooled_points(marked, features, label, "__held", edges).persist(StorageLevel.MEMORY_AND_DISK)
        dealt = points
        try:
            count, cores = points.count(), dataset.sparkSession.sparkContext.defaultParallelism
            # Every round reads the points again.
            dealt = points.repartition(max(1, min(cores, count // forest.LEAST_ROWS), count // forest.BLOCK_ROWS)).persist(StorageLevel.MEMORY_AND_DISK)
            stop = {"validationIndicatorCol": "held"} if mark else {}
            booster = GBTRegressor(**stop, featuresCol="__bins", labelCol="label", weightCol="weight", seed=plan["seed"], maxIter=plan["rounds"],
                                   stepSize=plan["learning_rate"], maxDepth=plan["max_depth"], maxBins=POINT_BINS)
            model = booster.fit(dealt)
        finally:
            dealt.unpersist()
            points.unpersist()
        return PipelineModel([Binned(featuresCol=features, edges=json.dumps(edges)), model,
                              SQLTransformer(statement="SELECT * EXCEPT (__bins) FROM __THIS__")])
