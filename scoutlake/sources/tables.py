"""Layer tables, delimited files and lookup tables."""


from pyspark.sql import functions as F

from ..config import lookups as lk


def read_delimited(spark, path, schema, sep=";"):
    """Delimited text with a header and a declared schema."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def write_delimited(df, path, sep=";"):
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_table(df, path, partition_by=None, max_records=1_000_000):
    """A layer table as Parquet, files of bounded size."""
    w = df.write.mode("overwrite").option("maxRecordsPerFile", max_records)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def read_table(spark, path):
    return spark.read.parquet(path)


_FIXED = {
    "event_types": ("id int, name string", lambda: list(lk.EVENT_TYPES.items())),
    "qualifiers": ("id int, name string", lambda: list(lk.QUALIFIERS.items())),
    "positions": ("raw string, position string", lambda: list(lk.POSITIONS.items())),
    "formations": ("formation string, canonical string", lambda: list(lk.FORMATIONS.items())),
    "country_elo": ("country string, elo double", lambda: [(k, float(v)) for k, v in lk.COUNTRY_ELO.items()]),
    "competition_weight": ("league string, k int", lambda: list(lk.COMPETITION_WEIGHT.items())),
    "competition_tier": ("league string, tier string", lambda: list(lk.COMPETITION_TIER.items())),
    "formation_family": ("formation string, family string", lambda: list(lk.FORMATION_FAMILY.items())),
}


def lookup(spark, name, path=None):
    """A lookup table: fixed ones from the package, larger ones from JSON or CSV files.

    ``formation_positions``: folder of <formation>.json {raw position: position};
    ``formation_slots``: {formation: {position: players}};
    ``formation_coords``: {formation: {position: [x, y] or [[x, y], ...]}};
    ``metric_lists``: {position: [metric, ...]};
    ``event_types`` / ``qualifiers`` with a path: the provider's CSV list.
    """
    if path is None:
        schema, rows = _FIXED[name]
        return spark.createDataFrame(rows(), schema)
    if name in ("event_types", "qualifiers"):
        kind = "eventType" if name == "event_types" else "qualifierType"
        df = spark.read.option("header", True).option("multiLine", True).csv(path)
        return df.select(F.col(kind + "Id").try_cast("int").alias("id"),
                         F.col(kind + "Name").alias("name")).dropna()
    text = spark.read.option("wholetext", True).text(path).select(
        "value", F.regexp_extract("_metadata.file_path", r"([^/]+)\.json$", 1).alias("file"))
    if name == "formation_positions":
        m = F.from_json("value", "map<string,string>")
        return text.select(F.replace("file", F.lit("_"), F.lit("-")).alias("formation"),
                           F.explode(m).alias("raw_position", "position"))
    if name == "formation_slots":
        m = F.from_json("value", "map<string,map<string,int>>")
        rows = text.select(F.explode(m).alias("formation", "s")).select(
            "formation", F.posexplode(F.map_entries("s")).alias("slot", "e"))
        return rows.select("formation", "slot", F.col("e.key").alias("position"),
                           F.col("e.value").alias("n")).filter("n > 0")
    if name == "formation_coords":
        m = F.from_json("value", "map<string,map<string,string>>")
        flat = text.select(F.explode(m).alias("formation", "p")).select(
            "formation", F.explode("p").alias("position", "xy"))
        many = F.from_json("xy", "array<array<double>>")
        one = F.array(F.from_json("xy", "array<double>"))
        pts = F.when(F.col("xy").startswith("[["), many).otherwise(one)
        return flat.select("formation", "position", F.posexplode(pts).alias("idx", "c")).select(
            "formation", "position", "idx", F.col("c")[0].alias("x"), F.col("c")[1].alias("y"))
    if name == "metric_lists":
        m = F.from_json("value", "map<string,array<string>>")
        return text.select(F.explode(m).alias("position", "metrics"))
    raise KeyError(name)
