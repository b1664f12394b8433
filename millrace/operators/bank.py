"""Card and loan defaulters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import dashed_date
from millrace.functions.text import missed_line, points_line

# The rules of the two products.
CLEARED_SHARE = 0.7
MEDICAL, PERSONAL = "Medical Loan", "Personal Loan"
MEDICAL_LATE_LIMIT = 3
MONTHS = 12
MISSED_ALLOWED = 4
GAP_ALLOWED = 2


def card_points() -> Column:
    """0 to 3 points for one statement."""
    spent, cleared = F.col("spent"), F.col("payment_cleared")
    short = (cleared < spent * F.lit(CLEARED_SHARE)).cast("int")
    full = spent == F.col("max_limit")
    pending = (full & (cleared < spent)).cast("int")
    return short + pending + F.when(full, short).otherwise(0)


def person() -> Column:
    return F.concat("customer_id", F.lit(", "), "first_name", F.lit(" "), "last_name")


def card_defaulters(cards: DataFrame) -> DataFrame:
    """Customers with points, with the sum over their statements."""
    keyed = cards.select("customer_id", person().alias("name"), card_points().alias("p"))
    points = keyed.groupBy("customer_id", "name").agg(F.sum("p").alias("points"))
    return points.where(F.col("points") > 0)


def consecutive_gap(months: Column) -> Column:
    """Longest run of months missing from a sorted array of months, ends included."""
    bounded = F.concat(F.array(F.lit(0)), months, F.array(F.lit(MONTHS + 1)))
    gaps = F.transform(
        F.slice(bounded, 2, F.size(months) + 1),
        lambda month, i: month - F.get(bounded, i) - 1,
    )
    return F.array_max(gaps)


def _histories(loans: DataFrame, *kinds: str) -> DataFrame:
    """Payment histories per customer of the given products, from one pass.

    The set of months has at most twelve elements, so it aggregates map-side like the
    counts do.
    """
    kind, paid = F.trim("loan_type"), dashed_date(F.col("payment_date"))
    personal = kind == PERSONAL
    late = (kind == MEDICAL) & (paid > dashed_date(F.col("due_date")))
    kept = loans.where(kind.isin(*kinds))
    return kept.groupBy("customer_id", person().alias("name")).agg(
        F.sum(late.cast("int")).alias("late"),
        F.count(F.when(personal, 1)).alias("payments"),
        F.array_sort(F.collect_set(F.when(personal, F.month(paid)))).alias("months"),
    )


def _medical_missed() -> Column:
    """Late payments if there are at least three."""
    return F.when(F.col("late") >= MEDICAL_LATE_LIMIT, F.col("late"))


def _personal_missed() -> Column:
    """Missed payments if more than four, else missed months in a row if more than two."""
    missed = F.lit(MONTHS) - F.col("payments")
    gap = consecutive_gap(F.col("months")).cast("bigint")
    reported = F.when(missed > MISSED_ALLOWED, missed).when(gap > GAP_ALLOWED, gap)
    return F.when(F.col("payments") > 0, reported)


def _reported(loans: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A row per customer and product whose rule reports something."""
    findings = F.explode(F.array(*rules.values())).alias("missed")
    histories = _histories(loans, *rules)
    return histories.select("customer_id", "name", findings).where("missed IS NOT NULL")


def medical_loan_defaulters(loans: DataFrame) -> DataFrame:
    """Customers with at least three payments after the due date."""
    return _reported(loans, {MEDICAL: _medical_missed()})


def personal_loan_months(loans: DataFrame) -> DataFrame:
    """Payments and distinct months per customer of a personal loan."""
    return _histories(loans, PERSONAL).drop("late")


def personal_loan_defaulters(loans: DataFrame) -> DataFrame:
    """Customers who missed more than four payments, or more than two in a row."""
    return _reported(loans, {PERSONAL: _personal_missed()})


def loan_defaulters_union(loans: DataFrame) -> DataFrame:
    """Personal and medical defaulters; a customer may be both, in two rows."""
    return _reported(
        loans, {PERSONAL: _personal_missed(), MEDICAL: _medical_missed()}
    )


def formatted_loan_defaulters(loans: DataFrame) -> DataFrame:
    return loan_defaulters_union(loans).select(
        missed_line(F.col("name"), F.col("missed")).alias("value")
    )


def defaulters_cogroup(cards: DataFrame, loans: DataFrame) -> DataFrame:
    """Card and loan findings per customer id, an empty list where there is none.

    Both sides are already down to a few findings per customer, so the lists are
    short whatever the number of statements.
    """
    card_line = points_line(F.col("name"), F.col("points"))
    loan_line = missed_line(F.col("name"), F.col("missed"))
    findings = (
        card_defaulters(cards)
        .select("customer_id", card_line.alias("card"))
        .unionByName(
            loan_defaulters_union(loans).select("customer_id", loan_line.alias("loan")),
            allowMissingColumns=True,
        )
    )
    return findings.groupBy("customer_id").agg(
        F.array_sort(F.collect_list("card")).alias("card_defaulter"),
        F.array_sort(F.collect_list("loan")).alias("loan_defaulter"),
    )
