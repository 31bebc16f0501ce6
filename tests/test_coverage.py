"""Sweeps around places and progress counters."""

import json

from pyspark.sql import functions as F

from leadmill.functions import geo
from leadmill.operators import coverage
from leadmill.sources import payloads
from leadmill.streaming import ingest, progress


def page(*ids, center=None, number=1):
    return json.dumps({"page": number, "location": {"latLng": center}, "results": [{"id": i, "businessName": "N"} for i in ids]})


def test_ring_sweep(spark):
    places = spark.createDataFrame([(1, "Miami, FL"), (2, "Nowhere"), (3, "Unasked"), (4, "Broken")], "place int, query string")
    center = spark.createDataFrame([(25.77, -80.19)], "lat double, lon double")
    ring = [r.q for r in geo.coverage_points(center, 25.0, 4).where("point > 0").orderBy("point").select(coverage.anchor_text(F.col("point_lat"), F.col("point_lon")).alias("q")).collect()]
    pages = [
        ("Miami, FL", 1, page("a", "b", center="25.77,-80.19")), ("Miami, FL", 2, page("c")), ("Miami, FL", 3, page("beyond the cap")),
        ("Nowhere", 1, page("n")), ("Nowhere", 2, page()), ("Broken", 1, "no json"), ("Broken", 2, page("never reached")),
        (ring[0], 1, page("a", None)), (ring[0], 2, page("d")), (ring[1], 1, page()), (ring[1], 2, page("never reached")), (ring[2], 2, page("never reached")),
    ]
    got = coverage.ring_sweep(places, spark.createDataFrame(pages, "query string, asked_page int, body string"), 25.0, 4, 2).collect()
    assert sorted((r.place, r.point, r.asked_page, r.listing_id) for r in got) == [(1, 0, 1, "a"), (1, 0, 1, "b"), (1, 0, 2, "c"), (1, 1, 1, "a"), (1, 1, 2, "d"), (2, 0, 1, "n")]
    counts = payloads.listing_counts(spark.createDataFrame([("x", page("a", None, "b")), ("y", "no json"), ("z", None)], "k string, body string")).orderBy("k").collect()
    assert [(r.readable, r["items"], r.kept, r.skipped) for r in counts] == [(True, 3, 2, 1), (False, 0, 0, 0), (False, 0, 0, 0)]


def test_progress_of_a_stream_and_of_stages(spark, tmp_path):
    land, table = str(tmp_path / "in"), str(tmp_path / "counters")
    spark.range(30).repartition(3).write.parquet(land)
    listener = progress.Progress(spark, table)
    spark.streams.addListener(listener)
    try:
        for _ in range(2):  # the second run finds nothing to do and counts nothing
            stream = progress.counted(ingest.landing(spark, land, spark.range(1).schema, 1), "numbers", even=F.col("id") % 2 == 0, none=F.lit(None).cast("boolean"))
            ingest.into_table(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
            assert listener.done.wait(60)
    finally:
        spark.streams.removeListener(listener)
    got = spark.read.parquet(table)
    assert {(r.counter, r.value) for r in progress.totals(got).collect()} == {("rows", 30), ("even", 15), ("none", 0)} and got.select("batch").distinct().count() == 3
    stages = progress.Stages(spark, str(tmp_path / "stages"), "run1")
    for _ in range(2):  # a stage that runs again replaces its counters
        stages.watched(spark.range(7), "one", small=F.col("id") < 3).write.mode("overwrite").parquet(str(tmp_path / "rows"))
        assert stages.written("one") == {"rows": 7, "small": 3}
    assert {tuple(r) for r in progress.totals(spark.read.parquet(str(tmp_path / "stages"))).collect()} == {("one", "rows", 7), ("one", "small", 3)}
