"""Names shared by the tests of the text operators."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
EXTRA = ["fp", "row", "hash", "id", "at", "mention", "toxic_score", "length", "key"]


def with_extra(df):
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in EXTRA])
