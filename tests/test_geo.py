"""Range tagging on grids of several sizes."""

import random

from pyspark.sql import functions as F

from tidewater.operators import geo

ZONES = "zone_id string, min_lat double, max_lat double, min_lon double, max_lon double"


def test_a_zone_is_at_most_nine_cells_however_large(spark):
    zones = [("tiny", 0.0, 0.001, 0.0, 0.001), ("point", 3.0, 3.0, 3.0, 3.0), ("huge", -5e8, 5e8, -5e8, 5e8), ("long", 0.0, 1e6, 5.0, 5.5),
             ("null", None, 1.0, 0.0, 1.0), ("turned", 2.0, 1.0, 0.0, 1.0)]
    counts = {r["zone_id"]: r["count"] for r in geo.zone_cells(spark.createDataFrame(zones, ZONES)).groupBy("zone_id").count().collect()}
    assert set(counts) == {"tiny", "point", "huge", "long"} and max(counts.values()) <= geo.CELLS_A_SIDE**2


def test_equals_a_plain_range_join(spark):
    rng = random.Random(5)
    zones = []
    for i in range(60):
        side = lambda: rng.choice([0.0, 0.3, 2.0, 50.0, 1e6])
        a, b = rng.uniform(-60, 60), rng.uniform(-60, 60)
        zones.append((f"z{i}", a, a + side(), b, b + side()))
    points = [(i, rng.choice([None, rng.uniform(-80, 80)]), rng.uniform(-80, 80)) for i in range(300)]
    points += [(1000 + i, z[1], z[4]) for i, z in enumerate(zones)] + [(7, 1.0, 1.0)] * 3
    p, z = spark.createDataFrame(points, "id int, lat double, lon double"), spark.createDataFrame(zones, ZONES)
    got = sorted((tuple(r) for r in geo.tag_points(p, z, "lat", "lon").collect()), key=str)
    want = []
    for i, lat, lon in points:
        inside = [] if lat is None else [n for n, a, b, c, d in zones if a <= lat <= b and c <= lon <= d]
        want += [(i, lat, lon, n) for n in inside or [None]]
    assert got == sorted(want, key=str)
    assert geo.tag_points(p, z.where(F.lit(False)), "lat", "lon").where("zone_id is null").count() == len(points)
