import random
import statistics

import pytest

from waybill.operators.median import exact_median
from waybill.plans.gold import route_performance


@pytest.mark.parametrize("bins", [2, 16, 1024])
def test_exact_median(spark, bins):
    rng = random.Random(3)
    rows = [("a", rng.uniform(0, 120)) for _ in range(301)]
    rows += [("b", float(rng.randrange(4))) for _ in range(200)]       # many copies
    rows += [("c", rng.uniform(50, 50.0001)) for _ in range(100)]      # all in one bin
    rows += [("d", 7.5), ("e", 1.0), ("e", 2.0), ("f", None)]
    rows += [("g", v) for v in (-50.0, -40.0, 500.0, 600.0, 700.0)]    # outside the range
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", 0.0, 120.0, "m", bins=bins).collect()}
    want = {}
    for key in "abcdeg":
        want[key] = statistics.median(v for k, v in rows if k == key)
    assert got == pytest.approx(want)


def test_route_performance_plans_agree(spark):
    rng = random.Random(9)
    rows = [(f"v{rng.randrange(20)}", "hot" if n % 3 else f"r{n % 5}", rng.uniform(0, 2),
             None if n % 11 == 0 else rng.uniform(0, 110)) for n in range(600)]
    rows += [("v1", "few", 1.0, 20.0)] * 4 + [("v9", "no_speed", 1.0, None)] * 9 + [("v1", None, 1.0, 5.0)] * 9
    movement = spark.createDataFrame(rows, "vehicle_id string, route_id string, distance_km double, speed_kmh double")
    plain, ranked = (
        {r.route_id: r for r in route_performance(movement, median_by_rank=flag).collect()}
        for flag in (False, True)
    )
    assert set(plain) == set(ranked) and "few" not in plain and "no_speed" not in plain and None not in plain
    for route, row in plain.items():
        assert tuple(row)[1:] == pytest.approx(tuple(ranked[route])[1:])
    hot = [r for r in rows if r[1] == "hot"]
    assert plain["hot"].active_vehicles == len({r[0] for r in hot})
    assert plain["hot"].median_speed_kmh == pytest.approx(statistics.median(r[3] for r in hot if r[3] is not None))
    assert plain["hot"].total_distance_km == pytest.approx(sum(r[2] for r in hot if r[3] is not None))


def test_crowded_bins_are_divided(spark):
    """All values in one fine bin, more than a task should rank."""
    rng = random.Random(4)
    rows = [("c", 50 + rng.random() * 1e-7) for _ in range(901)] + [("c", 50.0)] * 30 + [("d", 3.0)] * 9
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", 0.0, 120.0, "m", bins=16, crowded=20).collect()}
    assert got == {k: statistics.median(v for x, v in rows if x == k) for k in "cd"}
