"""Each rule, fed rows around its edge."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assay.operators.quality import (
    Matches, NotBefore, NotNegative, OneOf, Positive, Required, grade, rejection_reason,
)
from assay.plans.clock import Clock
from assay.plans.silver import refine, with_warning
from assay.sources import fixed_values as fixed
from assay.sources.specs import BY_NAME, SOURCES

DAY = Clock(date(2024, 1, 10))


def failing(spark, rule, schema, values):
    rows = spark.createDataFrame(values, schema)
    return [row[0] for row in rows.select(rejection_reason([rule])).collect()]


def test_required(spark):
    found = failing(spark, Required("a"), "a STRING", [(None,), ("",), ("x",)])
    assert found == ["a is null", None, None]


def test_domain_lets_null_through(spark):
    rule = OneOf("a", ("X", "Y"))
    assert failing(spark, rule, "a STRING", [("X",), ("Z",), ("x",), (None,)]) == [
        None, "invalid a", "invalid a", None,
    ]


@pytest.mark.parametrize("email, bad", [
    ("a.b@c.com", False), ("a+b_%@x-y.org", False), ("invalid-email", True), ("abc@", True),
    ("missing_at_symbol.com", True), ("a@b", True), ("a@b.c", True), ("a b@c.com", True),
    ("", True), (None, False),
])
def test_email(spark, email, bad):
    found = failing(spark, Matches("email", fixed.EMAIL_PATTERN), "email STRING", [(email,)])
    assert found == ["invalid email" if bad else None]


@pytest.mark.parametrize("postcode, bad", [
    ("2000", False), ("0200", False), ("200", True), ("20000", True), ("20A0", True), (None, False),
])
def test_postcode(spark, postcode, bad):
    rule = Matches("postcode", fixed.POSTCODE_PATTERN)
    assert failing(spark, rule, "postcode STRING", [(postcode,)]) == [
        "invalid postcode" if bad else None
    ]


def test_amounts(spark):
    values = [(-1.0,), (0.0,), (0.01,), (None,)]
    text = "a must be greater than zero"
    assert failing(spark, Positive("a"), "a DOUBLE", values) == [text, text, None, None]
    text = "a must be greater than or equal to zero"
    assert failing(spark, NotNegative("a"), "a DOUBLE", values) == [text, None, None, None]


def test_interval_is_day_grain(spark):
    rule = NotBefore("b", "a")
    day, before = date(2024, 1, 2), date(2024, 1, 1)
    values = [(day, before), (day, day), (before, day), (day, None), (None, day)]
    assert failing(spark, rule, "a DATE, b DATE", values) == [
        "negative resolution time", None, None, None, None,
    ]


def test_first_failing_rule_wins(spark):
    rows = spark.createDataFrame([(None, "Z"), ("k", "Z"), ("k", "X")], "a STRING, b STRING")
    graded = grade(rows, [Required("a"), OneOf("b", ("X",))])
    assert [tuple(row) for row in graded.collect()] == [
        (None, "Z", False, "a is null"), ("k", "Z", False, "invalid b"), ("k", "X", True, None),
    ]


def test_rule_counts_and_texts():
    counts = {spec.name: len(spec.rules) for spec in SOURCES}
    assert counts == {
        "customers": 3, "addresses": 6, "orders": 7, "payments": 11, "support_tickets": 13,
        "loyalty_accounts": 10,
    }
    assert BY_NAME["payments"].rules[2].reason == "order_id does not exist in silver orders"
    assert BY_NAME["orders"].rules[3].reason == "invalid status"


def ticket(**values):
    columns = BY_NAME["support_tickets"].columns
    return tuple(values.get(name) for name in columns)


def test_ticket_warning_ignores_a_missing_end_but_not_a_missing_start(spark):
    spec = BY_NAME["support_tickets"]
    past, future = date(2024, 1, 9), date(2024, 1, 11)
    rows = spark.createDataFrame(
        [(past, None), (past, future), (future, None), (None, future), (None, past), (None, None)],
        "ticket_created_at DATE, ticket_resolved_at DATE",
    )
    flags = with_warning(rows, spec, DAY).select("_has_future_ticket_date").collect()
    assert [row[0] for row in flags] == [False, True, True, True, None, None]


def test_loyalty_warning_is_unknown_when_either_date_is(spark):
    rows = spark.createDataFrame(
        [(date(2024, 1, 9), None), (date(2024, 1, 11), None), (None, date(2024, 1, 11)),
         (date(2024, 1, 10), date(2024, 1, 10))],
        "join_date DATE, updated_at DATE",
    )
    flags = with_warning(rows, BY_NAME["loyalty_accounts"], DAY).select("_has_future_date")
    assert [row[0] for row in flags.collect()] == [None, True, True, False]


# --- the whole refinement against plain Python ------------------------------------------------

statuses = st.sampled_from(["active", " Inactive ", "vip", None])
emails = st.sampled_from([" A@b.co ", "bad", None])
days = st.sampled_from(["2024-01-01", "2024-01-12 08:00:00", "not-a-date", None])
customer_rows = st.lists(
    st.tuples(st.sampled_from(["C1", "C2", "C3", None]), emails, statuses, days),
    min_size=0, max_size=12,
)


def reason_of(key, email, status):
    if key is None:
        return "customer_id is null"
    if email == "bad":
        return "invalid email"
    return "invalid status" if status == "vip" else None


def parsed(text):
    if text is None or text == "not-a-date":
        return None
    return date.fromisoformat(text[:10])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(customer_rows)
def test_customers_match_a_plain_reading(spark, rows):
    spec = BY_NAME["customers"]
    place = {name: i for i, name in enumerate(spec.columns)}
    data = []
    for key, email, status, updated in rows:
        row = [None] * len(place)
        row[place["customer_id"]], row[place["email"]] = key, email
        row[place["status"]], row[place["updated_at"]] = status, updated
        data.append(tuple(row))
    graded = refine(spark.createDataFrame(data, spec.schema), spec, clock=DAY)
    found = {
        row["customer_id"]: (row["email"], row["status"], row["updated_at"],
                             row["_rejection_reason"], row["_is_valid"])
        for row in graded.collect()
    }
    assert graded.count() == len(found)

    def text(value):
        return (value is not None, value or "")

    expected = {}
    for key in {row[0] for row in rows}:
        cleaned = [
            (e and e.strip().lower(), s and s.strip().lower(), parsed(u))
            for k, e, s, u in rows if k == key
        ]
        best = max(cleaned, key=lambda c: (
            c[2] is not None, c[2] or date.min, text(c[0]), text(c[1])
        ))
        reason = reason_of(key, best[0], best[1])
        expected[key] = (*best, reason, reason is None)
    assert found == expected


def test_refining_refined_rows_changes_nothing(spark):
    spec = BY_NAME["customers"]
    row = ["C1", " A ", "B", "a@b.co", None, "1990-01-01", "MALE", "2020-01-01", "ACTIVE",
           "2020-01-01", "2020-02-01", "crm"]
    once = refine(spark.createDataFrame([tuple(row)] * 3, spec.schema), spec, clock=DAY)
    again = once.select([F.col(c.name).cast(c.dataType).alias(c.name) for c in spec.schema])
    twice = refine(again, spec, clock=DAY)
    assert once.collect() == twice.collect()
    assert once.count() == 1
