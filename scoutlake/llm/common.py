"""Registration and small helpers shared by the text operators."""

import sys
import types

from pyspark.sql import functions as F

from scoutlake.session import materialize, scratch_path

__all__ = ["ORACLE", "QUERIES", "fold", "materialize", "qualified", "query", "scratch_path", "small", "table",
           "worker_state"]

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    """Register a query and, where SQL can say the same, its check."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return add


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(column, k):
    """crc32 of a value's text modulo k; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % k


def qualified(spark, folder):
    """The folder with its file system, which a path without a scheme takes from the cluster's default."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def small(batches, size=8 << 20, fresh=False):
    """Arrow batches or arrays cut into parts of about ``size`` bytes, so that few texts are Python strings at a time.

    ``fresh`` lets go what the worker remembers from other stages first.
    """
    if fresh:
        worker_state().clear()
    for b in batches:
        step = max(1, len(b) * size // max(1, b.nbytes))
        for at in range(0, len(b), step):
            yield b.slice(at, step)


def worker_state():
    """Dict that lives as long as the Python worker, so that later tasks find what earlier ones learned."""
    name = "scoutlake_worker_state"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].state = {}
    return sys.modules[name].state
