import json

from rows import tuples
from pyspark.sql import functions as F

from millrace.functions.parsing import parse_event_log, with_event_time
from millrace.operators import basics, traffic

ROW = {
    "ip": "203.0.113.9", "id": "u-17", "lat": 1.25, "lng": -2.5,
    "user_agent": "probe", "age_bracket": "41-55", "opted_into_marketing": False,
    "http_request": "PUT /form", "http_response": 404,
    "file_size_bytes": 60, "event_datetime": "2023-08-09T10:11:12.500",
    "event_ts": 1691575872500,
}


def log(spark, *changes):
    rows = [(json.dumps({**ROW, **change}),) for change in changes]
    return parse_event_log(spark.createDataFrame(rows, "value STRING"))


def test_parse(spark):
    row = log(spark, {}).drop("_corrupt").head().asDict()
    assert row == ROW


def test_missing_places(spark):
    changes = [
        {"lat": None, "lng": None}, {"lat": "", "lng": 3.0}, {"lat": 5, "lng": ""},
        {"lat": 0, "lng": 3.0}, {"lat": 1, "lng": 0.0}, {"lat": "7.5", "lng": -2},
    ]
    places = [(r.lat, r.lng) for r in log(spark, *changes).collect()]
    assert places == [(-1.0, -1.0)] * 5 + [(7.5, -2.0)]


def test_bad_line_is_kept(spark):
    row = parse_event_log(spark.createDataFrame([("{not json",)], "value STRING")).head()
    assert row._corrupt == "{not json" and row.id is None


def test_user_traffic(spark):
    sizes = [60, 9, 500, 31]
    rows = log(spark, *[{"file_size_bytes": n} for n in sizes], {"id": "other"})
    expected = [("other", 1, 60, 60, 60), ("u-17", 4, sum(sizes), 500, 9)]
    columns = ["id", "page_views", "total_bytes", "max_bytes", "min_bytes"]
    assert tuples(traffic.user_traffic(rows), *columns) == expected
    assert tuples(traffic.user_traffic_sql(rows), *columns) == expected


def timed(spark, *times):
    changes = [{"event_datetime": f"2023-08-09T{x}"} for x in times]
    return with_event_time(log(spark, *changes))


def test_twenty_second_windows(spark):
    rows = timed(spark, "10:11:00.000", "10:11:19.999", "10:11:20.000", "10:12:39.500")
    counts = traffic.tumble_count_user(rows)
    assert tuples(counts, "id", "page_views") == [("u-17", 1), ("u-17", 1), ("u-17", 2)]
    by_sql = traffic.tumble_count_user_sql(rows)
    assert tuples(by_sql, "event_id", "window_start", "window_end", "page_views") == [
        ("u-17", "2023-08-09 10:11:00", "2023-08-09 10:11:20", 2),
        ("u-17", "2023-08-09 10:11:20", "2023-08-09 10:11:40", 1),
        ("u-17", "2023-08-09 10:12:20", "2023-08-09 10:12:40", 1),
    ]


def test_minutes(spark):
    rows = timed(spark, "10:59:59.999", "11:00:00.000", "11:00:30.000", "11:00:59.999")
    start = F.date_format("window_start", "HH:mm")
    assert tuples(traffic.tumble_count_global(rows), start, "page_views") == [
        ("10:59", 1), ("11:00", 3),
    ]
    assert tuples(traffic.tumble_count_sql(rows), "window_start", "page_views") == [
        ("2023-08-09 10:59:00", 1), ("2023-08-09 11:00:00", 3),
    ]


def test_optin_and_datetime(spark):
    rows = log(spark, {}, {"opted_into_marketing": True, "id": "7"}, {"opted_into_marketing": None})
    kept = basics.filter_select_optin(rows)
    assert kept.columns == ["ip", "id", "lat", "lng", "age_bracket"]
    assert tuples(kept, "id") == [("7",)]
    assert basics.normalise_datetime(rows).head().event_datetime == "2023-08-09 10:11:12"


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "'x' AS name", "id AS value").write.parquet(
        str(tmp_path / "items")
    )
    items = spark.read.parquet(str(tmp_path / "items"))
    plan = basics.sql_filter_eq(items, "x")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,x)" in plan
