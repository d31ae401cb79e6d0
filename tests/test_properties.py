"""Any batch against a plain Python reading of the rules."""

from collections import Counter

from card_rows import card
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe import CARD, build_silver, monthly, monthly_from_wide, reconcile
from tallyframe.operators import gate, quality

texts = st.sampled_from(["0", "1", "2", "02", "3", "9", "10", "-1", "-3", "oops", "1.5", None])
rows = st.builds(
    lambda i, limit, age, pay, paid, bill: card(
        ID=i, LIMIT_BAL=limit, AGE=age, PAY_3=pay, PAY_AMT2=paid, BILL_AMT3=bill
    ),
    st.sampled_from(["1", "2", "02", "3", "4", "5", "6", "0", None, "x"]),
    st.sampled_from(["100000", "0", "500000"]),
    st.sampled_from(["30", "30", "17", None]),
    texts, texts, texts,
)


def number(text):
    try:
        return int(text) if text is not None and "_" not in text else None
    except ValueError:
        return None


def expected(batch):
    unique = set(batch)
    typed = {r: dict(zip(CARD.columns, map(number, r))) for r in unique}
    ids = Counter(t["ID"] for t in typed.values() if t["ID"] is not None)
    reasons = {}
    for row, t in typed.items():
        known = {c: v for c, v in t.items() if v is not None}
        broken = []
        if len(known) < len(t):
            broken.append("missing_or_noninteger")
        if known.get("ID", 1) <= 0:
            broken.append("invalid_account_id")
        if known.get("LIMIT_BAL", 1) <= 0:
            broken.append("nonpositive_credit_limit")
        if not 18 <= known.get("AGE", 18) <= 120:
            broken.append("age_out_of_range")
        if ids.get(t["ID"], 0) > 1:
            broken.append("conflicting_account_id")
        if not -2 <= known.get("PAY_3", 0) <= 9:
            broken.append("invalid_PAY_3")
        if known.get("PAY_AMT2", 0) < 0:
            broken.append("negative_PAY_AMT2")
        reasons[row] = "|".join(broken)
    return reasons


@settings(max_examples=10, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(batch=st.lists(rows, min_size=1, max_size=25), heavy_keys=st.sampled_from([1, 2, 10**6]))
def test_any_batch(spark, cards, batch, heavy_keys):
    reasons = expected(batch)
    checked = quality.check_rows(cards(*batch), heavy_keys=heavy_keys)
    found = checked.select("raw.*", quality.REASON, quality.COPIES).collect()
    assert {tuple(r)[:25]: r.rejection_reason for r in found} == reasons
    assert len(found) == len(reasons)
    assert {tuple(r)[:25]: r.copies for r in found} == dict(Counter(batch))

    counts = gate.batch_counts(checked).first()
    accepted_rows = sum(r == "" for r in reasons.values())
    assert counts.raw_rows == len(batch)
    assert counts.accepted_accounts == accepted_rows
    assert counts.accepted_accounts + counts.rejected_rows == counts.unique_rows

    accepted = quality.accepted_rows(checked)
    dimension, facts = build_silver(accepted, "r")
    assert facts.count() == 6 * accepted_rows
    assert dimension.select("account_id").distinct().count() == accepted_rows
    assert reconcile(monthly(facts), monthly_from_wide(accepted)).count() == 0

    shuffled = quality.check_rows(cards(*batch).orderBy(F.rand(1)), heavy_keys=heavy_keys)
    assert shuffled.exceptAll(checked).count() == 0
