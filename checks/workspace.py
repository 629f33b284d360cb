"""The shared folder that the checks write to."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import SparkSession


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-checks-")


def shared_folder(spark: SparkSession) -> str | None:
    """``checks`` below the one that the session names; a folder of this machine where the session runs on it alone.

    What a query returns is read from there later, so it stays, apart from the staging of runs.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/checks"
    master = spark.conf.get("spark.master", "")
    alone = master.startswith("local") and not master.startswith("local-cluster")
    return _own_folder() if alone else None
