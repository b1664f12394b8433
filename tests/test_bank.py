from rows import tuples
from pyspark.sql import functions as F

from millrace.operators import bank
from millrace.sources import files

def card(customer, limit, spent, cleared, first="Ana", last="Lund"):
    return f"{customer},{first},{last},rel,kind,{limit},{spent},0,{cleared},05-05-2021"


# Points by rule, at each of its bounds: customer -> (limit, spent, cleared, points).
STATEMENTS = {
    "below": (1000, 200, 139, 1),
    "seventy": (1000, 200, 140, 0),
    "full": (800, 800, 799, 1),
    "both": (800, 800, 559, 3),
    "paid": (800, 800, 800, 0),
    "nothing": (50, 0, 0, 0),
}


def loan(customer, kind, due, paid):
    return (customer, "First", "Last", "Job", "LN", kind, due, 2000, paid)


def loans_table(spark, rows):
    return spark.createDataFrame(rows, files.LOANS)


def personal(months, customer="P"):
    return [loan(customer, "Personal Loan", "01-01-2018", f"05-{m:02d}-2018") for m in months]


def cards_table(spark, tmp_path, rows):
    path = tmp_path / "cards.csv"
    path.write_text("header line\n" + "\n".join(rows) + "\n")
    return files.read_delimited(spark, str(path), files.CARDS, header=True)


def test_card_points(spark, tmp_path):
    rows = [card(name, *numbers) for name, (*numbers, _) in STATEMENTS.items()]
    cards = cards_table(spark, tmp_path, rows + [card("both", 10, 10, 0)])
    assert cards.count() == len(STATEMENTS) + 1
    points = {name: numbers[-1] for name, numbers in STATEMENTS.items()} | {"both": 6}
    assert tuples(bank.card_defaulters(cards), "customer_id", "name", "points") == sorted(
        (name, f"{name}, Ana Lund", n) for name, n in points.items() if n
    )


def test_medical_needs_three_late_payments(spark):
    def payments(customer, *days):
        """Payments so many days after the 10th of a month."""
        return [
            loan(customer, " Medical Loan ", " 10-06-2020", f"{10 + d:02d}-06-2020 ") for d in days
        ]

    rows = payments("three", 1, 9, 20) + payments("two", 1, 9, 0, -4) + payments("four", 1, 1, 2, 3, -1)
    found = bank.medical_loan_defaulters(loans_table(spark, rows))
    assert tuples(found, "customer_id", "missed") == [("four", 4), ("three", 3)]


def expected_personal(months):
    """The rule, restated on plain lists."""
    months = sorted(months)
    if 12 - len(months) > 4:
        return 12 - len(months)
    edges = [0, *months, 13]
    gap = max(b - a - 1 for a, b in zip(edges, edges[1:]))
    return gap if gap > 2 else None


def test_personal_loans(spark):
    cases = {
        "few": [2, 9, 11], "gap": [1, 2, 3, 7, 8, 9, 10, 11, 12],
        "start": [4, 5, 6, 7, 8, 9, 10, 11, 12], "end": [1, 2, 3, 4, 5, 6, 7, 8],
        "fine": list(range(1, 13)), "two": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10],
        "twice": [1, 1, 1, 2, 2, 3, 8, 9, 12], "thirteen": list(range(1, 13)) + [5],
    }
    rows = [row for name, months in cases.items() for row in personal(months, name)]
    found = bank.personal_loan_defaulters(loans_table(spark, rows))
    expected = {n: expected_personal(m) for n, m in cases.items()}
    assert tuples(found, "customer_id", "missed") == sorted(
        (n, v) for n, v in expected.items() if v is not None
    )


def test_year_of_payment_does_not_count(spark):
    rows = personal(range(1, 8))
    rows += [loan("P", "Personal Loan", "01-01-2018", f"05-{m:02d}-2019") for m in range(8, 13)]
    assert bank.personal_loan_defaulters(loans_table(spark, rows)).collect() == []


def test_union_and_cogroup(spark, tmp_path):
    medical = [loan("x", "Medical Loan", "03-03-2020", "04-03-2020")] * 5
    loans = loans_table(spark, medical + personal([6], "x") + personal([2, 4, 8], "z"))
    assert tuples(bank.formatted_loan_defaulters(loans), "value") == [
        ("x, First Last, 11 missed",), ("x, First Last, 5 missed",),
        ("z, First Last, 9 missed",),
    ]
    cards = cards_table(spark, tmp_path, [card("x", 90, 90, 0), card("y", 90, 10, 0)])
    both = bank.defaulters_cogroup(cards, loans)
    found = {r.customer_id: (r.card_defaulter, r.loan_defaulter) for r in both.collect()}
    assert found == {
        "x": (
            ["x, Ana Lund, 3 fraud_points"],
            ["x, First Last, 11 missed", "x, First Last, 5 missed"],
        ),
        "y": (["y, Ana Lund, 1 fraud_points"], []),
        "z": ([], ["z, First Last, 9 missed"]),
    }


def test_consecutive_gap(spark):
    df = spark.createDataFrame([([2, 3, 9],), ([7],), (list(range(1, 13)),)], "m ARRAY<INT>")
    gaps = [r[0] for r in df.select(bank.consecutive_gap(F.col("m"))).collect()]
    assert gaps == [5, 6, 0]
