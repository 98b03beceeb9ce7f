"""Fitted pipelines on disk, with what is needed to judge them fairly later."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from chatsieve.operators.forest import ForestModel, load_forest, save_forest
from chatsieve.operators.term_models import TermModel, load_terms, save_terms


def save_model(spark: SparkSession, model: PipelineModel | TermModel | ForestModel, path: str, **metadata) -> None:
    """Write vectoriser and classifier together, and the split they were trained on
    (such as seed and fraction) as metadata."""
    kind = {TermModel: "terms", ForestModel: "forest"}.get(type(model), "pipeline")
    if kind == "terms":
        save_terms(model, f"{path}/terms")
    elif kind == "forest":
        save_forest(model, f"{path}/forest")
    else:
        model.write().overwrite().save(f"{path}/pipeline")
    kept = {"kind": kind, "metadata": metadata}
    note = spark.createDataFrame([(json.dumps(kept, sort_keys=True),)], "value string")
    note.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel | TermModel | ForestModel, dict]:
    """Read a saved model; a missing one is an error."""
    kept = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    if kept["kind"] == "terms":
        return load_terms(spark, f"{path}/terms"), kept["metadata"]
    if kept["kind"] == "forest":
        return load_forest(spark, f"{path}/forest"), kept["metadata"]
    return PipelineModel.load(f"{path}/pipeline"), kept["metadata"]
