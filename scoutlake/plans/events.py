"""Event job: feed documents to pass and shot maps."""

from pyspark.sql import functions as F

from ..operators.joins import map_column
from ..operators.shape import pass_map, shot_map
from ..session import job, materialize
from ..sources import raw
from ..sources.tables import read_table, write_table


def run_events(spark, raw_root, unified, out):
    """All matches with a feed document at once; ids become internal ids."""
    with job(spark, "events", raw_root, unified, out):
        return _run(spark, raw_root, unified, out)


def _run(spark, raw_root, unified, out):
    teams, players, matches = (read_table(spark, f"{unified}/{t}") for t in ("team", "player", "match"))

    def ids(df):
        return df.filter("IdSW IS NOT NULL").select(F.col("IdSW").alias("key"), F.col("ID").alias("value"))

    known = matches.filter("IdSW IS NOT NULL").select(F.col("IdSW").alias("match"))
    docs = raw.read_json(spark, f"{raw_root}/eventing/*.json", raw.EVENTS).withColumn("match", raw.file_stem())
    ev, quals = raw.events(docs.join(known, "match", "left_semi"))
    rich = materialize(raw.enrich_events(ev, quals), "events")
    for name, make in (("pass_map", pass_map), ("shot_map", shot_map)):
        df = map_column(make(rich, ids(teams), ids(players)), "Match", ids(matches))
        write_table(df, f"{out}/events/{name}")
    return f"{out}/events"
