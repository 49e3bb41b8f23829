"""Python workers that can import this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

HOME = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session find this package where the driver has it.

    On a cluster it is shipped with the job (``--py-files`` or the image).
    """
    sc = spark.sparkContext
    known = sc.environment.get("PYTHONPATH", "")
    if sc.master.startswith("local") and HOME not in known.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, HOME]))
