"""Python workers find this library where the driver found it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_library(df: DataFrame) -> DataFrame:
    """``df`` itself; workers started from now on look for modules beside the driver's copy, too."""
    known = df.sparkSession.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (known.get("PYTHONPATH"), ROOT) if x)
    return df
