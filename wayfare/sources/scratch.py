"""Run folders for written tables, stream checkpoints and models."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Folders handed out in the scopes that are open, innermost last.
_OPEN: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; where it names none, a folder of the warehouse, which is shared too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return root.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one run; never reused, so runs cannot collide. An open scope owns it."""
    path = f"{scratch_root(spark)}/wayfare/{label}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Owner of the run folders handed out inside: they are deleted at its end, when results are written or read, and left
    for a look at them if it fails. Tables that are still to be read must not come from inside."""
    _OPEN.append([])
    try:
        yield
    except BaseException:
        _OPEN.pop()
        raise
    for path in _OPEN.pop():
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
