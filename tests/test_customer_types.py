"""The join-free customer counts against the plain recipe, on random sales."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.plans import kpis
from tests.frames import facts, values

START = dt.datetime(2018, 1, 1, 23, 59, 57)
TIMES = st.none() | st.integers(0, 6).map(lambda s: START + dt.timedelta(seconds=s)) | st.integers(0, 3).map(
    lambda d: START + dt.timedelta(days=d)
)
SALES = st.lists(st.tuples(st.none() | st.integers(1, 4), TIMES), max_size=25)


def expected(sales, grain):
    first = {}
    for customer, at in sales:
        if at is not None:
            first[customer] = min(first.get(customer, at), at)
    seen = defaultdict(set)
    for customer, at in sales:
        if customer is not None:
            kind = "Repeat" if at is not None and at > first[customer] else "New"
            bucket = at.replace(hour=0, minute=0, second=0) if grain == "day" and at is not None else at
            seen[bucket, kind].add(customer)
    rows = [(bucket, kind, len(customers)) for (bucket, kind), customers in seen.items()]
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(sales=SALES)
def test_counts_equal_the_plain_recipe(spark, sales):
    fact = facts(spark, [(customer, None if at is None else str(at), 1.0) for customer, at in sales])
    for grain in ("second", "day"):
        assert values(kpis.customer_type_counts(fact, grain)) == expected(sales, grain)
