import pytest
from rows import tuples
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import basics, staff
from millrace.sources.values import from_values

SCHEMA = "id STRING, name STRING, dept_no INT, dept STRING, date STRING"
NAMES = ["Yu", "Ivo", "Lena", "Marek", "Ottilie", "Wilhelmina"]


def visits():
    """Person n is n + 1 times in Accounts, and every second one once in HR."""
    rows = []
    for n, name in enumerate(NAMES):
        rows += [(f"p{n}", name, 7, "Accounts", f"{day}-11-2022") for day in range(n + 1)]
        if n % 2:
            rows.append((f"p{n}", name, 40, "HR", "20-11-2022"))
    return rows


@pytest.fixture
def attendance(spark):
    return spark.createDataFrame(visits(), SCHEMA)


def test_counts(attendance):
    accounts = sorted((name, n + 1) for n, name in enumerate(NAMES))
    hr = [(name, 1) for name in NAMES[1::2]]
    assert tuples(staff.sum_per_key(attendance), "name", "n") == accounts
    assert tuples(staff.group_then_count(attendance), "name", "n") == accounts
    assert tuples(staff.sum_struct_key(attendance), "employee.name", "total") == sorted(
        (name, 7 * (n + 1) + 40 * (n % 2)) for n, name in enumerate(NAMES)
    )
    union = tuples(staff.flatten_union(attendance), "name", "n")
    assert union == sorted(accounts + hr)
    parts = staff.union_counts(
        staff.sum_per_key(attendance), staff.sum_per_key(attendance, "HR")
    )
    assert tuples(parts, "name", "n") == union


def kept(staff_rows, unwanted, *bounds):
    return {r.name for r in basics.filter_by_length_side(staff_rows, unwanted, *bounds).collect()}


def test_name_lengths(attendance):
    lengths = {name: len(name) for name in NAMES}
    for shortest, longest in [(3, 7), (4, 4), (8, 9), (7, None)]:
        bounds = (shortest,) if longest is None else (shortest, longest)
        assert kept(attendance, [], *bounds) == {
            n for n, size in lengths.items() if shortest <= size <= (longest or 99)
        }


@pytest.mark.parametrize("length", [3, 1000, 1001, 5000])
def test_side_list_of_any_length_or_table(spark, attendance, length):
    rows = attendance.unionByName(spark.createDataFrame([(None, "Nobody", 7, "HR", "")], SCHEMA))
    unwanted = ["p1", "p4", *(f"q{i}" for i in range(length - 2))]
    expected = {"Nobody", "Yu", "Lena", "Marek", "Wilhelmina"}
    table = spark.createDataFrame([(i,) for i in unwanted], "unwanted STRING")
    assert kept(rows, unwanted, 1) == kept(rows, table, 1) == expected
    with_null = table.unionByName(spark.createDataFrame([(None,)], "unwanted STRING"))
    assert kept(rows, [*unwanted, None], 1) == kept(rows, with_null, 1) == expected - {"Nobody"}


def test_routes(attendance):
    outputs = basics.routed(basics.route_names(attendance.select("name").distinct()))
    short = sorted((n,) for n in NAMES if len(n) <= 4)
    assert tuples(outputs["short_names"], "name") == short
    assert tuples(outputs["long_names"], "name") == sorted((n,) for n in NAMES if len(n) > 4)
    assert outputs["main"].collect() == []


def test_evens(spark):
    digits = spark.createDataFrame([("1",), ("2",), ("4",)], "x STRING")
    assert tuples(basics.filter_evens(digits, "x"), "x") == [("2",), ("4",)]
    words = spark.createDataFrame([("one",)], "x STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        basics.filter_evens(words, "x").collect()


def test_items(spark):
    items = from_values(
        spark, [(i, f"item{i}", i / 4) for i in range(5)], "id INT, name STRING, value DOUBLE"
    )
    assert tuples(basics.sql_filter_eq(items, "item3"), "id", "name", "value") == [(3, "item3", 0.75)]
    assert tuples(basics.add_constant(items), "value") == [(1000 + i / 4,) for i in range(5)]
    numbers = basics.squares_cubes(from_values(spark, range(10), "x BIGINT"), "x")
    assert tuples(numbers, "x", "square", "cube") == [(x, x * x, x**3) for x in range(10)]


def test_values_of_a_mapping_are_its_keys(spark):
    rows = from_values(spark, {"row1": [1, 2], "row2": [3]}, "v STRING")
    assert tuples(rows, "v") == [("row1",), ("row2",)]


def test_csv_lines(spark):
    lines = from_values(spark, ["a,b,,d"], "value STRING")
    assert basics.split_csv_row(lines).head().fields == ["a", "b", "", "d"]
    assert [r.field for r in basics.split_csv_flat(lines).collect()] == ["a", "b", "", "d"]


def test_literal_is_not_a_pattern(spark):
    lines = from_values(spark, ["a\r\nb", "x/r/ny"], "value STRING")
    cleaned = lines.select(tx.remove_literal(F.col("value"), "/r/n").alias("v"))
    assert tuples(cleaned, "v") == [("a\r\nb",), ("xy",)]
