"""Property test: MRR movements equal a pairwise brute force on random data."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from subledger.operators import revenue as rv

from test_models_small import _brute_force, _rev

DATES = [dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 29),
         dt.date(2024, 3, 1), dt.date(2024, 3, 31), dt.date(2024, 4, 1)]
row = st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(DATES), st.sampled_from(["pro", "starter"]),
                st.one_of(st.none(), st.sampled_from(["10", "20", "20", "35.50", "655.35", "655.36", "1500.25", "99999.99"])))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=14))
def test_movements_equal_brute_force(spark, records):
    hist = rv.revenue_histogram(_rev(spark, records))
    cm = rv.customer_month(hist)
    want_new, want_exp, want_churn = _brute_force(records)
    got_new = {r[rv.T]: (r["new_mrr"], r["new_customers"]) for r in rv.new_mrr(cm).collect()}
    got_exp = {r[rv.T]: (r["expansion_mrr"], r["expanded_customers"]) for r in rv.expansion_mrr(hist).collect()}
    got_churn = {}
    for r in rv.churned_mrr(cm).collect():
        a, n = got_churn.get(r[rv.T], (Decimal(0), 0))
        got_churn[r[rv.T]] = (a + r["churned_mrr"], n + r["churned_customers"])
    assert got_new == want_new
    assert got_exp == want_exp
    assert got_churn == want_churn
