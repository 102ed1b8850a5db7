"""JSON configuration files, read through Spark so that any file system works."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def load_json(spark: SparkSession, path: str):
    """One JSON document (an object or an array) as Python values; meant for small settings."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
