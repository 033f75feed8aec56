"""Replacing an output: write aside, then swap by rename."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """Yields a folder to write to; what ``path`` held is replaced when the block ends well.

    A block that fails leaves the old output as it was, and the block may read what it
    replaces, as both are there until the swap.  The swap is two renames on the file
    system of ``path``; if the second fails, the first is taken back.  Readers that
    listed the old files before the swap have to list them again.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark._jsc.hadoopConfiguration())
    at = folder.makeQualified(at)
    mark = uuid.uuid4().hex
    # A name that begins with a dot is no part of a table that holds the folder.
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}-{kind}-{mark}") for kind in ("new", "old"))
    try:
        yield new.toString()
    except BaseException:
        folder.delete(new, True)
        raise
    if not folder.exists(new):
        raise FileNotFoundError(f"nothing was written to replace {path}")
    folder.mkdirs(at.getParent())
    had_output = folder.exists(at)
    if had_output and not folder.rename(at, old):
        folder.delete(new, True)
        raise OSError(f"{path} cannot be moved aside")
    if not folder.rename(new, at):
        if had_output:
            folder.rename(old, at)
        raise OSError(f"{path} cannot be put in place")
    if had_output:
        folder.delete(old, True)
    spark.catalog.refreshByPath(path)
