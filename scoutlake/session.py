"""Scratch storage shared by all executors, for cutting lineage, and the steps of jobs."""

import contextlib
import contextvars
import hashlib
import uuid


class _Running:
    """The running job of this context: its folder and how many steps it has asked for.

    Functions for executors take their modules along by value; there no job is running.
    """

    def __init__(self):
        self._own = contextvars.ContextVar("scoutlake_job", default=None)

    def __reduce__(self):
        return _Running, ()

    def get(self):
        return self._own.get()

    def set(self, job):
        return self._own.set(job)

    def reset(self, token):
        self._own.reset(token)


_JOB = _Running()


def scratch_root(spark):
    """Folder of the cluster's ``spark.checkpoint.dir``; where that is unset, one in the session's warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark, name):
    return f"{scratch_root(spark).rstrip('/')}/scoutlake-{name}-{uuid.uuid4().hex}"


def _store(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark, path):
    store, path = _store(spark, path)
    return store.exists(path)


@contextlib.contextmanager
def job(spark, name, *about):
    """A job whose materialized frames are numbered steps in one folder, named by the job and what it is about.

    A step is done when Spark has marked its folder complete. A run of the same job that was stopped leaves its
    steps; the next one reads those that are done and goes on from there. The folder is removed when the job has
    ended well. Steps are known by number and name, so a job's code must ask for them in the same order; change
    ``about`` (inputs, season, date) and it is another job.
    """
    key = hashlib.sha1(repr((name, *about)).encode()).hexdigest()[:16]
    folder = f"{scratch_root(spark).rstrip('/')}/scoutlake-job-{name}-{key}"
    token = _JOB.set({"folder": folder, "steps": 0})
    try:
        yield folder
    finally:
        _JOB.reset(token)
    store, path = _store(spark, folder)
    store.delete(path, True)


def materialize(df, name, partition_by=None):
    """Write a frame to the scratch folder and read it back: short lineage, safe on loss; a step inside a job."""
    spark, running = df.sparkSession, _JOB.get()
    if running is None:
        path, mode = scratch_path(spark, name), "error"
    else:
        running["steps"] += 1
        path, mode = f"{running['folder']}/{running['steps']:05d}-{name}", "overwrite"
        if exists(spark, f"{path}/_SUCCESS"):
            return spark.read.schema(df.schema).parquet(path)
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
