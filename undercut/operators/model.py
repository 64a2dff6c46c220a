"""Random-forest training and scoring with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from undercut.operators.features import FEATURES, pit_features

# Forest settings. Two features are tried per split, floor(sqrt(6)).
FOREST = {"numTrees": 64, "maxDepth": 12, "minInstancesPerNode": 4, "seed": 42}
FEATURE_SUBSET, MAX_BINS = "2", 256


def train(labelled: DataFrame) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", featureSubsetStrategy=FEATURE_SUBSET, maxBins=MAX_BINS, **FOREST
    )
    return Pipeline(stages=[assembler, forest]).fit(labelled)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(events: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``pit_probability``; events without features yield no row.

    Works on streams. Enriched or not plays no part here.
    """
    kept = events.columns
    return (
        model.transform(pit_features(events))
        .withColumn("pit_probability", F.get(vector_to_array("probability"), F.lit(1)))
        .select(*kept, "pit_probability")
    )
