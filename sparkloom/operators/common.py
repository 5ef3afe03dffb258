"""Helpers of operators that must not be computed twice."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def materialised(df: DataFrame) -> DataFrame:
    """A checkpoint of df in the folder that the session names in spark.checkpoint.dir; a temporary one only where none is set and the master is this machine."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sparkloom-"))
    return df.checkpoint()
