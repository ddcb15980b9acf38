"""Steps of jobs: a stopped job goes on from its finished steps, an ended one leaves nothing."""

import os

import pytest
from pyspark.sql import functions as F

from scoutlake import session
from scoutlake.sources import raw, sinks


def folders(spark):
    root = session.scratch_root(spark).removeprefix("file:").replace("//", "/")
    return sorted(n for n in os.listdir(root) if n.startswith("scoutlake-job-")) if os.path.isdir(root) else []


def test_a_stopped_job_goes_on(spark):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    def run(stop, about=1):
        with session.job(spark, "sum", about):
            one = session.materialize(spark.range(100).mapInArrow(count, "id long"), "one")
            two = session.materialize(one.groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")), "two", ["k"])
            if stop:
                raise RuntimeError("lost")
            return sorted(tuple(r) for r in two.select("k", "s").collect())

    before = folders(spark)
    with pytest.raises(RuntimeError):
        run(True)
    assert ran.value == 100 and len(folders(spark)) == len(before) + 1
    with pytest.raises(RuntimeError):
        run(True, about=2)  # another job: its own steps
    assert ran.value == 200
    want = sorted((k, sum(range(k, 100, 7))) for k in range(7))
    assert run(False) == want and ran.value == 200
    assert run(False, about=2) == want and ran.value == 200 and folders(spark) == before
    assert run(False) == want and ran.value == 300 and folders(spark) == before
    free = session.materialize(spark.range(3), "free")
    assert free.count() == 3 and folders(spark) == before


def test_a_half_written_step_is_written_again(spark):
    with pytest.raises(RuntimeError):
        with session.job(spark, "half") as folder:
            session.materialize(spark.range(5), "one")
            raise RuntimeError("lost")
    path = f"{folder}/00001-one".removeprefix("file:").replace("//", "/")
    for name in os.listdir(path):
        if "_SUCCESS" in name:
            os.unlink(f"{path}/{name}")
    with session.job(spark, "half"):
        assert session.materialize(spark.range(7), "one").count() == 7


def test_documents_are_added_by_the_manifest(spark, tmp_path):
    path = str(tmp_path)
    df = spark.range(1_000).select(F.col("id").alias("ID"), F.concat(F.lit("n"), "id").alias("Name"))
    sinks.write_documents(df.filter("ID < 600"), "x", path, skip_existing=True, bucket_rows=100)
    assert sinks.written_ids(spark, "x", path).agg(F.max("buckets"), F.countDistinct("bucket")).first()[0] == 6
    for folder, _, files in os.walk(f"{path}/x"):
        for name in files:
            if name.endswith(".txt"):  # documents that can't be read: the next run must not try
                with open(f"{folder}/{name}", "w") as f:
                    f.write("broken\n")
                crc = f"{folder}/.{name}.crc"
                if os.path.exists(crc):
                    os.unlink(crc)
    sinks.write_documents(df, "x", path, skip_existing=True, bucket_rows=100)
    ids = sinks.written_ids(spark, "x", path)
    assert ids.count() == 1_000 == ids.select("id").distinct().count()
    assert ids.agg(F.max("buckets")).first()[0] == 6
    new = spark.read.text(f"{path}/x").filter("value <> 'broken'").select(F.get_json_object("value", "$.ID").cast("int").alias("i"))
    assert sorted(r["i"] for r in new.collect()) == list(range(600, 1_000))
    sinks.write_documents(df.limit(10), "x", path, bucket_rows=100)
    assert sinks.written_ids(spark, "x", path).count() == 10


def test_functions_take_their_modules_along(spark):
    """A function for executors that names a module of the package carries it by value, job state included."""
    from scoutlake.llm import bloom

    with session.job(spark, "pickled"):
        got = spark.range(3).rdd.map(lambda r: (bloom.segments_for(r["id"]), session._JOB.get())).collect()
    assert got == [(1, None)] * 3


def test_squads_are_parsed_once(spark):
    """Players, staff and the last team of staff read the people that were parsed, not the documents."""
    doc = """{"squad": [{"contestantId": "t%d", "person": [{"id": "p%d", "type": "player", "shirtNumber": 4},
                                                            {"id": "c", "type": "coach", "shortFirstName": "Ann"}]}]}"""
    docs = spark.createDataFrame([(doc % (i, i), "L", "24") for i in (1, 2)], "doc string, League string, Season string")
    players, staff = raw.squads(raw.parse_json(docs, "doc", raw.SQUADS, ["League", "Season"]))
    assert {(r.IdSW, r.Team, r.League, r.ShirtNumber) for r in players.collect()} == {("p1", "t1", "L", 4), ("p2", "t2", "L", 4)}
    assert {(r.IdSW, r.Type, r.Team) for r in staff.collect()} == {("c", "coach", "t2")}
    for out in (players, staff):
        assert "from_json" not in out._jdf.queryExecution().toString()


def test_event_documents_are_parsed_once(spark):
    """Events and qualifiers read the rows that were parsed, not the documents."""
    doc = """{"liveData": {"event": [{"id": 7, "typeId": 1, "contestantId": "t", "playerId": "p",
                                      "qualifier": [{"qualifierId": 140, "value": "3.5"}]}]}}"""
    docs = spark.createDataFrame([(doc, "m")], "doc string, match string")
    ev, quals = raw.events(raw.parse_json(docs, "doc", raw.EVENTS, ["match"]))
    assert [(r.match, r.eventId, r.player) for r in ev.collect()] == [("m", 7, "p")]
    assert [(r.match, r.eventId, r.qualifierId, r.value) for r in quals.collect()] == [("m", 7, 140, "3.5")]
    for out in (ev, quals):
        assert "from_json" not in out._jdf.queryExecution().toString()
