"""JSON document sinks."""

import math

from pyspark.sql import functions as F

from ..operators.shape import prune
from ..session import exists


def documents(df, id_col="ID"):
    """(id, doc) rows: each row as a JSON object without empty fields."""
    clean = prune(df, id_cols=[id_col])
    return clean.select(F.col(id_col).cast("string").alias("id"),
                        F.to_json(F.struct(*clean.columns)).alias("doc"))


def written_ids(spark, kind, path):
    """(id, bucket, buckets) of the documents of a kind that are there, from its manifest; None if there is none."""
    known = f"{path}/_ids/{kind}"
    return spark.read.schema("id string, bucket int, buckets int").parquet(known) if exists(spark, known) else None


def write_documents(df, kind, path, id_col="ID", skip_existing=False, folder="bucket", bucket_rows=50_000):
    """One JSON object per line under ``<path>/<kind>/bucket=NN``, found again by its id's hash.

    The first write takes a bucket for each ``bucket_rows`` documents, a write task each, and later ones keep that
    number.  A manifest beside the documents lists the ids, in files with Bloom filters on the id, so
    ``skip_existing``, which adds only ids that are not there yet, reads no document; the documents are written
    before their ids are.  One small file per id does not scale to many entities; ``folder="id"`` still writes that
    layout.
    """
    spark, target = df.sparkSession, f"{path}/{kind}"
    old = written_ids(spark, kind, path) if skip_existing else None
    new, buckets = df, None
    if old is not None:
        new = df.join(old.select(F.col("id").alias("_known")), F.col(id_col).cast("string") == F.col("_known"), "left_anti")
        buckets = old.agg(F.max("buckets")).first()[0]
    if buckets is None:
        buckets = max(1, math.ceil(df.count() / bucket_rows))
    own = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("bucket")
    docs = documents(new, id_col)
    if folder == "bucket":
        docs = docs.select("doc", own).repartition(buckets, "bucket")
    mode = "append" if skip_existing else "overwrite"
    docs.write.mode(mode).option("maxRecordsPerFile", 100_000).partitionBy(folder).text(target)
    ids = new.select(F.col(id_col).cast("string").alias("id")).select("id", own, F.lit(buckets).alias("buckets"))
    ids.write.mode(mode).option("parquet.bloom.filter.enabled#id", "true").parquet(f"{path}/_ids/{kind}")


def comparison_rows(metrics, percentiles, id_col, part=None):
    """(part, id, metrics JSON, percentiles JSON) rows, one per entity."""
    keys = [part] if part else []
    m = metrics.select(*keys, id_col, F.to_json(F.struct(
        *[c for c in metrics.columns if c not in keys])).alias("Metrics"))
    p = percentiles.select(*keys, id_col, F.to_json(F.struct(
        *[c for c in percentiles.columns if c not in keys])).alias("Percentiles"))
    return m.join(p, [*keys, id_col])


def write_comparison(rows, path, part=None):
    """Comparison rows as JSON documents, a folder per position."""
    w = rows.write.mode("overwrite").option("maxRecordsPerFile", 100_000)
    (w.partitionBy(part) if part else w).json(path)
