"""Staff and bank queries over customers, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.operators import bank, staff

SUM_SQL = f"SELECT name, count(*) AS n FROM ({t.STAFF_SQL}) WHERE dept = 'BUILDING' GROUP BY name"


@query("sum_per_key", SUM_SQL)
def sum_per_key(spark, sf_dir):
    return staff.sum_per_key(t.staff(spark, sf_dir), "BUILDING")


@query("group_then_count", SUM_SQL)
def group_then_count(spark, sf_dir):
    return staff.group_then_count(t.staff(spark, sf_dir), "BUILDING")


@query(
    "sum_struct_key",
    f"SELECT id, name, CAST(sum(dept_no) AS BIGINT) AS total FROM ({t.STAFF_SQL}) GROUP BY id, name",
)
def sum_struct_key(spark, sf_dir):
    return staff.sum_struct_key(t.staff(spark, sf_dir)).select("employee.*", "total")


@query(
    "flatten_union",
    f"""SELECT name, count(*) AS n FROM ({t.STAFF_SQL})
        WHERE dept IN ('BUILDING', 'MACHINERY') GROUP BY dept, name""",
)
def flatten_union(spark, sf_dir):
    return staff.flatten_union(t.staff(spark, sf_dir), "BUILDING", "MACHINERY")


def _bank(select: str) -> str:
    return f"WITH {t.BANK_SQL} {select}"


@query("card_defaulters", _bank("SELECT customer_id, name, points FROM card_defaulters"))
def card_defaulters(spark, sf_dir):
    return bank.card_defaulters(t.cards(spark, sf_dir))


@query("medical_loan_defaulters", _bank("SELECT customer_id, name, missed FROM medical"))
def medical_loan_defaulters(spark, sf_dir):
    return bank.medical_loan_defaulters(t.loans(spark, sf_dir))


@query("personal_loan_defaulters", _bank("SELECT customer_id, name, missed FROM personal"))
def personal_loan_defaulters(spark, sf_dir):
    return bank.personal_loan_defaulters(t.loans(spark, sf_dir))


@query(
    "consecutive_gap",
    _bank("SELECT customer_id, CAST(greatest(gap, 0) AS BIGINT) AS gap FROM personal_all"),
)
def consecutive_gap(spark, sf_dir):
    months = bank.personal_loan_months(t.loans(spark, sf_dir))
    gap = bank.consecutive_gap(F.col("months")).cast("bigint")
    return months.select("customer_id", gap.alias("gap"))


@query(
    "loan_defaulters_union",
    _bank(
        """SELECT name || ', ' || missed || ' missed' AS value FROM personal
           UNION ALL SELECT name || ', ' || missed || ' missed' FROM medical"""
    ),
)
def loan_defaulters_union(spark, sf_dir):
    return bank.formatted_loan_defaulters(t.loans(spark, sf_dir))


@query(
    "defaulters_cogroup",
    _bank(
        """,
        findings AS (
            SELECT customer_id, name || ', ' || points || ' fraud_points' AS card,
                   NULL AS loan FROM card_defaulters
            UNION ALL SELECT customer_id, NULL, name || ', ' || missed || ' missed' FROM personal
            UNION ALL SELECT customer_id, NULL, name || ', ' || missed || ' missed' FROM medical
        )
        SELECT customer_id, count(card) AS cards, count(loan) AS loans,
               coalesce(string_agg(card, '|' ORDER BY card), '') AS card_defaulter,
               coalesce(string_agg(loan, '|' ORDER BY loan), '') AS loan_defaulter
        FROM findings GROUP BY customer_id"""
    ),
)
def defaulters_cogroup(spark, sf_dir):
    both = bank.defaulters_cogroup(t.cards(spark, sf_dir), t.loans(spark, sf_dir))
    return both.select(
        "customer_id",
        F.size("card_defaulter").cast("bigint").alias("cards"),
        F.size("loan_defaulter").cast("bigint").alias("loans"),
        F.array_join("card_defaulter", "|").alias("card_defaulter"),
        F.array_join("loan_defaulter", "|").alias("loan_defaulter"),
    )
