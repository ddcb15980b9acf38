"""The five jobs, end to end, on the invented league."""

import pytest
from pyspark.sql import functions as F

import world
from scoutlake.plans.events import run_events
from scoutlake.plans.fit import run_fit
from scoutlake.plans.metrics import run_metrics
from scoutlake.plans.publish import run_publish
from scoutlake.plans.unify import run_unify
from scoutlake.sources.tables import lookup

AS_OF = "2026-03-01"
METRICS = {"CB": ["PassAccuracy", "TackleAccuracy", "DuelWinRate", "PassesPer90", "TacklesPer90"],
           "ST": ["PassAccuracy", "GoalConversion", "GoalsPer90", "TotalShotsPer90", "DuelWinRate"]}


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    root = world.build(str(tmp_path_factory.mktemp("raw")))
    out = str(tmp_path_factory.mktemp("out"))
    unified = run_unify(spark, root, out, AS_OF)
    events = run_events(spark, root, unified, out)
    fm = lookup(spark, "formation_positions", f"{root}/lookups/formations/*.json")
    metrics = run_metrics(spark, unified, events, out, world.SEASON, AS_OF, fm, METRICS)
    slots = lookup(spark, "formation_slots", f"{root}/lookups/slots.json")
    coords = lookup(spark, "formation_coords", f"{root}/lookups/coords.json")
    run_publish(spark, metrics, events, out, world.SEASON, AS_OF, slots, coords, METRICS, similar=5)
    run_fit(spark, metrics, events, out, world.SEASON, AS_OF)
    return out


def read(spark, out, name):
    return spark.read.parquet(f"{out}/{name}")


def test_unify(spark, out):
    teams = read(spark, out, "unified/team")
    assert teams.count() == world.TEAMS
    assert teams.filter("IdSS IS NULL OR IdSW IS NULL").count() == 0
    right = teams.filter(F.col("IdSW") == F.concat(F.lit("t"), (F.col("IdSS") - 100).cast("int").cast("string")))
    assert right.count() == world.TEAMS
    players = read(spark, out, "unified/player")
    assert players.count() == world.TEAMS * world.SQUAD + 1           # one without a partner, the broken one skipped
    both = players.filter("IdSS IS NOT NULL AND IdSW IS NOT NULL")
    assert both.count() == world.TEAMS * world.SQUAD
    assert both.filter(F.concat(F.lit("p"), "IdSS") != F.col("IdSW")).count() == 0
    managers = read(spark, out, "unified/manager")
    assert managers.filter("IdSS IS NOT NULL AND IdSW IS NOT NULL").count() == world.TEAMS
    matches = read(spark, out, "unified/match")
    assert matches.count() == 30 and matches.filter("IdSS IS NULL OR IdSW IS NULL").count() == 0
    stats = read(spark, out, "unified/player_stats")
    assert stats.filter("MinutesPlayed > 0").count() == 30 * 22
    team_stats = read(spark, out, "unified/team_stats")
    assert team_stats.count() == 60 and team_stats.filter("Manager IS NULL OR Formation <> '4-3-3'").count() == 0


def test_events(spark, out):
    passes, shots = read(spark, out, "events/pass_map"), read(spark, out, "events/shot_map")
    assert passes.count() > 500 and shots.count() > 200
    assert passes.filter("Match IS NULL OR Team IS NULL OR Player IS NULL").count() == 0
    assert passes.filter("AccuratePass = 0 AND PassReceiver IS NOT NULL").count() == 0
    assert shots.filter("Length < 0 OR GoalY IS NULL").count() == 0


def test_metrics(spark, out):
    matches = read(spark, out, "metrics/match")
    assert matches.count() == 30 and matches.filter("HomeElo IS NULL OR HomeScore IS NULL").count() == 0
    teams = read(spark, out, "metrics/team")
    assert teams.filter("EloRating IS NULL OR Manager IS NULL").count() == 0
    assert teams.filter("PrimaryColour = '#ffffff'").count() == 0
    stats = read(spark, out, "metrics/player_stats")
    assert stats.filter("Rating IS NULL OR Rating < 0 OR Rating > 10").count() == 0
    players = read(spark, out, "metrics/player")
    rated = players.filter("Rating IS NOT NULL")
    assert rated.count() == world.TEAMS * 11
    assert rated.filter("Rating < 65 OR Rating > 95 OR Potential < 65 OR Potential > 99").count() == 0
    centroids = read(spark, out, "metrics/role_centroids")
    sizes = {(r["Position"], len(r["center"])) for r in centroids.collect()}
    assert sizes == {("CB", 5), ("ST", 5)} and centroids.groupBy("Position").count().filter("count < 3").count() == 0
    assert players.filter("Role IS NOT NULL").select("Position").distinct().count() == 2
    agg = read(spark, out, "metrics/agg_player")
    scopes = {r["scope"]: r["m"] for r in agg.groupBy("scope").agg(F.max("Matches").alias("m")).collect()}
    assert scopes == {"all": 10, "season": 10, "last10": 10, "last5": 5, "last3": 3}


def test_publish(spark, out):
    docs = spark.read.text(f"{out}/entities/team")
    assert docs.count() == world.TEAMS
    lineup = read(spark, out, "nested/team_lineup").select("Team", F.explode("Lineup").alias("l"))
    assert lineup.count() == world.TEAMS * 11
    assert lineup.filter("l.X IS NULL").count() == 0
    similar = read(spark, out, "nested/player_similar").select("id", F.explode("SimilarPlayers").alias("s"))
    assert similar.groupBy("id").agg(F.max("s.Num").alias("n")).filter("n > 5").count() == 0
    matches = read(spark, out, "nested/player_matches")
    assert matches.count() > 0
    comparison = spark.read.json(f"{out}/comparison/players")
    assert comparison.filter("Metrics IS NULL").count() == 0


def test_fit(spark, out):
    scores = read(spark, out, "fit/scores")
    assert scores.count() == world.TEAMS * 11 * (world.TEAMS - 1)
    assert scores.filter("Score < 0 OR Score > 1").count() == 0
    spans = scores.groupBy("team").agg(F.min("Stars").alias("a"), F.max("Stars").alias("b")).collect()
    assert all(r["a"] == 0.5 and r["b"] == 5.0 for r in spans)
