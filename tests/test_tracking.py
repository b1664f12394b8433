import random

from rows import tuples
from pyspark.sql import functions as F

from millrace.functions import pace
from millrace.functions.parsing import parse_positions
from millrace.operators import tracking
from millrace.plans import panes

SECOND = panes.SECOND


def positions(spark, at, rows):
    data = [(user, spot, at(seconds), i) for i, (user, spot, seconds) in enumerate(rows)]
    return spark.createDataFrame(data, "user STRING, spot INT, ts TIMESTAMP, seq BIGINT")


# One user slows down, one speeds up, one keeps a steady pace (a spot a second).
PACE_CASE = [
    ("slow", 0, 2), ("fast", 0, 2), ("even", 0, 2), ("slow", 18, 20), ("fast", 18, 20),
    ("even", 18, 20), ("slow", 20, 38), ("fast", 108, 38), ("even", 36, 38),
]


def pace_status(rows, short, long):
    """Status by user and short window, from sums over plain lists."""
    paths = {}
    for user, spot, at in rows:
        paths.setdefault(user, []).append((at, spot))
    found = []
    for user, path in paths.items():
        steps = [(a[0], abs(b[1] - a[1]), b[0] - a[0]) for a, b in zip(path, path[1:])]

        def ratio(start, end, steps=steps):
            inside = [x for x in steps if start <= x[0] < end]
            return sum(x[1] for x in inside) / sum(x[2] for x in inside)

        for start in {at // short * short for at, *_ in steps}:
            end = start + short
            share = ratio(start, end) / ratio(end - long, end)
            status = "under" if share < 0.9 else "" if share < 1.1 else "out"
            found.append((user, f"{status}performing" if status else "pacing"))
    return sorted(found)


def test_speed_by_sql(spark):
    path = [("u", 3, 1), ("u", 9, 4), ("u", 5, 3), ("v", 8, 0), ("v", 8, 2), ("u", 1, 6), ("u", 4, 9)]
    texts = ["\t".join(map(str, row)) for row in path]
    rows = parse_positions(spark.createDataFrame([(x,) for x in texts], "value STRING"))
    speeds = tracking.track_speed_sql(rows, 5 * SECOND)
    assert tuples(speeds, "user", "speed") == [("u", 1.0), ("u", 2.0), ("v", 0.0)]


def test_malformed_positions_stay(spark):
    lines = ["u\t3\t1.5", "u\tx\t2", "u\t4", "", "u\t5\tsoon", "u\t6\t1e300", None, "u\t7\tNaN"]
    rows = parse_positions(spark.createDataFrame([(x,) for x in lines], "value STRING"))
    found = [(r.user, r.spot, r.ts is not None, r._corrupt) for r in rows.collect()]
    assert found == [
        ("u", 3, True, None),
        ("u", None, True, lines[1]),
        ("u", 4, False, lines[2]),
        ("", None, False, ""),
        ("u", 5, False, lines[4]),
        ("u", 6, False, lines[5]),
        (None, None, False, None),
        ("u", 7, False, lines[7]),
    ]


def walk(seed=3, count=900):
    """Two users, one with two thirds of the rows, in no order of time."""
    rng = random.Random(seed)
    rows = [
        (rng.choice(["a", "a", "b"]), rng.randrange(100), rng.randrange(5000) / 4)
        for _ in range(count)
    ]
    return rows + [("still", 5, 10.0)]


def path_speed(rows, user):
    path = sorted((s, i, spot) for i, (u, spot, s) in enumerate(rows) if u == user)
    distance = sum(abs(b[2] - a[2]) for a, b in zip(path, path[1:]))
    lasted = path[-1][0] - path[0][0]
    return distance / lasted if lasted else 0.0


def test_track_speed_recomputed(spark, at):
    rows = walk()
    for chunks in (4, 1000):
        speeds = tracking.track_speed(positions(spark, at, rows), "seq", chunks=chunks)
        found = {r.user: r.speed for r in speeds.collect()}
        assert set(found) == {"a", "b", "still"}
        for user in found:
            assert abs(found[user] - path_speed(rows, user)) < 1e-9


def test_running_track_speed_ends_at_track_speed(spark, at):
    table = positions(spark, at, walk())
    so_far = tracking.running_track_speed(table, "seq", chunks=4)
    assert so_far.count() == table.count()
    order = F.struct("ts", "seq")
    last = so_far.groupBy("user").agg(F.max_by("speed", order).alias("speed"))
    whole = tracking.track_speed(table, "seq")
    assert tuples(last, "user", "speed") == tuples(whole, "user", "speed")


def test_boxed_metrics_drop_pairs_without_duration(spark, at):
    rows = [("u", 0, 1), ("u", 9, 1), ("u", 4, 3)]
    metrics = tracking.boxed_metrics(positions(spark, at, rows), "seq")
    shown = tuples(metrics, "user", F.unix_seconds("ts"), "distance", "duration")
    assert shown == [("u", 1, 5, 2 * SECOND)]


def metrics_of(spark, at, rows):
    return tracking.boxed_metrics(positions(spark, at, rows), "seq")


def test_motivation_cases(spark, at):
    metrics = metrics_of(spark, at, PACE_CASE)
    for short, long in [(20, 100), (20, 40), (10, 90)]:
        args = (metrics, short * SECOND, long * SECOND)
        expected = pace_status(PACE_CASE, short, long)
        assert len({status for _, status in expected}) == 3
        for form in (tracking.motivation_cogroup, tracking.motivation_side_input):
            assert tuples(form(*args), "user", "status") == expected
        by_sql = tracking.motivation_sql(*args)
        assert tuples(by_sql, "user", "performance") == expected


def test_motivation_forms_agree(spark, at):
    metrics = metrics_of(spark, at, walk())
    for short, long in [(20, 100), (30, 70)]:
        args = (metrics, short * SECOND, long * SECOND)
        columns = ("user", "window_start", "status")
        cogrouped = tuples(tracking.motivation_cogroup(*args), *columns)
        assert cogrouped == tuples(tracking.motivation_side_input(*args), *columns)
        assert len(cogrouped) > 20


def test_sql_form_keeps_short_pace_of_zero(spark, at):
    rows = [("u", 0, 0), ("u", 9, 10), ("u", 9, 21), ("u", 9, 30)]
    args = (metrics_of(spark, at, rows), 20 * SECOND, 40 * SECOND)
    start = F.unix_seconds("window_start")
    assert tuples(tracking.motivation_cogroup(*args), start) == [(0,)]
    assert tuples(tracking.motivation_sql(*args), start, "performance")[1] == (
        20, "underperforming",
    )


def test_pace_status_limits(spark):
    cases = [
        (0.89, 1.0, "underperforming"), (0.9, 1.0, "pacing"), (1.09, 1.0, "pacing"),
        (1.1, 1.0, "outperforming"), (0.0, 1.0, None), (1.0, 0.0, None), (None, 1.0, None),
    ]
    df = spark.createDataFrame(cases, "s DOUBLE, l DOUBLE, expected STRING")
    status = pace.pace_status(F.col("s"), F.col("l")).alias("status")
    assert all(r.status == r.expected for r in df.select(status, "expected").collect())


def test_mean_pace(spark, at):
    metrics = metrics_of(spark, at, [("u", 0, 0), ("u", 6, 2), ("u", 0, 4)])
    assert tuples(tracking.mean_pace(metrics), "user", "pace") == [("u", 3.0)]
    nothing = metrics.withColumn("duration", F.lit(0).cast("bigint"))
    assert str(tracking.mean_pace(nothing).head().pace) == "nan"
