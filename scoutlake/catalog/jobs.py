"""Checks of whole jobs, on documents and tables that Spark derives from the check tables and writes first."""

from pyspark.sql import functions as F

from ..plans.events import run_events
from ..session import scratch_path
from ..sources.tables import read_table, write_table
from .views import FEED, feed, query, r


def _qualifiers(*pairs):
    each = [F.when(v.isNotNull(), F.struct(F.lit(q).alias("qualifierId"), v.cast("string").alias("value"))) for q, v in pairs]
    return F.array_compact(F.array(*each))


def write_feed(spark, sf, root):
    """A feed document per match under ``root``/eventing, and unified ids of matches, teams and players."""
    ev = feed(spark, sf)
    col = lambda c: F.col(f"`{c}`")
    type_id = F.when(F.col("Type") == "Pass", 1).when(F.col("Type") == "Goal", 16).when(F.col("Type") == "Miss", 13) \
        .when(F.col("Type") == "Post", 14).otherwise(15)
    one = F.struct("ts", "event_id", F.struct(
        F.col("event_id").alias("id"), type_id.cast("int").alias("typeId"), F.concat(F.lit("t"), "team").alias("contestantId"),
        F.concat(F.lit("p"), "player").alias("playerId"), "outcome", "x", "y", _qualifiers(
            (140, col("Pass End X")), (141, col("Pass End Y")), (213, col("Angle")), (56, col("Zone")),
            (102, col("Goal Mouth Y Coordinate")), (103, col("Goal Mouth Z Coordinate")),
            (146, col("Blocked X Coordinate")), (147, col("Blocked Y Coordinate"))).alias("qualifier")).alias("e"))
    docs = ev.groupBy(F.concat(F.col("match").cast("string"), F.lit(".json")).alias("match")).agg(
        F.transform(F.array_sort(F.collect_list(one)), lambda x: x["e"]).alias("event"))  # the events of a match, as in its document
    docs.select("match", F.to_json(F.struct(F.struct("event").alias("liveData"))).alias("doc")) \
        .write.partitionBy("match").text(f"{root}/eventing")
    for name, c, tag in (("team", "team", "t"), ("player", "player", "p"), ("match", "match", "")):
        key = F.col(c).cast("string")
        write_table(ev.select(F.concat(F.lit(f"{name}-"), key).alias("ID"), F.concat(F.lit(tag), key).alias("IdSW")).distinct(),
                    f"{root}/unified/{name}")


@query("k2_event_job", f"""
WITH {FEED}, n AS (SELECT *, lead(player) OVER (PARTITION BY match ORDER BY ts, event_id) AS nxt FROM v_feed),
p AS (SELECT 'pass' AS kind, match, team, player, x, y, zone, CASE WHEN outcome <> 0 THEN nxt END AS other,
        sqrt(power((end_x - x) * 105.0::DOUBLE / 100, 2) + power((end_y - y) * 68.0::DOUBLE / 100, 2)) AS l FROM n WHERE type = 'Pass' AND nxt IS NOT NULL
      UNION ALL SELECT 'shot', match, team, player, x, y, zone, NULL,
        sqrt(power((100 - x) * 105.0::DOUBLE / 100, 2) + power((coalesce(goal_y, 50) - y) * 68.0::DOUBLE / 100, 2)) FROM n WHERE type <> 'Pass')
SELECT kind, 'match-' || strftime(match, '%Y-%m-%d') AS "Match", 'team-' || team AS "Team", 'player-' || player AS "Player",
  'player-' || other AS "PassReceiver", x AS "IniX", y AS "IniY", zone AS "Zone", {r('l', 2)} AS "Length" FROM p""")
def k2(spark, sf):
    """Feed documents through the event job, both maps read back."""
    root = scratch_path(spark, "event-job")
    write_feed(spark, sf, root)
    out = run_events(spark, root, f"{root}/unified", f"{root}/out")
    cols = ["Match", "Team", "Player", "PassReceiver", "IniX", "IniY", "Zone", "Length"]
    passes = read_table(spark, f"{out}/pass_map").select(F.lit("pass").alias("kind"), *cols)
    shots = read_table(spark, f"{out}/shot_map").withColumn("PassReceiver", F.lit(None).cast("string"))
    return passes.unionByName(shots.select(F.lit("shot").alias("kind"), *cols))
