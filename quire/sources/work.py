"""A folder for tables between two steps of one query."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, tag: str) -> str:
    """A new path below spark.checkpoint.dir, which all executors share.

    Where that is unset, a session on one machine (of a test) gets a temporary folder; on a cluster it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
