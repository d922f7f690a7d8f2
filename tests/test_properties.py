"""Property tests: random small payment sets against a brute-force evaluation.

The window rules run at the original windows (1 minute velocity, 10 minutes
cross-border and decline rate) over rows that share a few cards within a
few minutes, so every rule fires in some examples. Every strategy must give
exactly the flags of a plain Python evaluation, and quarantine routing must
account for every row.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import payment
from ledgerlake.config import DEFAULT_CONFIG
from ledgerlake.plans.bronze import enrich

BASE = dt.datetime(2026, 5, 29, 6, 55, 0)
CARDS = ["C1", "C2", None]
LOCATIONS = ["New York, USA", "London, UK", "Paris", None, "Lyon, France,", ""]
AUTHS = ["DECLINED", "APPROVED", "declined", None]

row = st.tuples(
    st.sampled_from(CARDS),
    # Seconds after BASE: a dense 3-minute span (velocity fires), the
    # whole 14 minutes (bucket edges), or -1 for a malformed timestamp.
    st.one_of(st.integers(min_value=0, max_value=179), st.integers(min_value=0, max_value=14 * 60), st.just(-1)),
    st.sampled_from(LOCATIONS),
    st.sampled_from(AUTHS),
    st.sampled_from(["USD", "usd", None]),
    st.one_of(st.none(), st.floats(min_value=0, max_value=20000, allow_nan=False)),
)


# A burst of 0, 5, 6 or 9 payments of card C1 inside one minute, so the velocity
# threshold (more than 5) is crossed in some examples and just missed in others.
burst = st.tuples(st.sampled_from([0, 5, 6, 9]), st.sampled_from(LOCATIONS), st.sampled_from(AUTHS)).map(
    lambda t: [("C1", 120 + i, t[1], t[2], "USD", 10.0) for i in range(t[0])]
)
payment_rows = st.tuples(st.lists(row, min_size=1, max_size=60), burst).map(lambda t: t[0] + t[1])


def _country(location):
    if location is None:
        return "UNKNOWN"
    parts = location.split(",")
    return parts[-1].strip() if len(parts) > 1 else "UNKNOWN"


def _expected(rows):
    """Window flags by brute force: group rows by (card, epoch-aligned bucket)."""
    groups = {60: defaultdict(list), 600: defaultdict(list)}
    for i, (card, sec, location, auth, _, _) in enumerate(rows):
        if card is None or sec < 0:
            continue
        epoch = int((BASE + dt.timedelta(seconds=sec)).replace(tzinfo=dt.timezone.utc).timestamp())
        for size, g in groups.items():
            g[(card, epoch // size)].append(i)
    out = {i: {"is_high_velocity": False, "is_cross_border": False, "is_high_decline_rate": False}
           for i in range(len(rows))}
    for members in groups[60].values():
        if len(members) > 5:
            for i in members:
                out[i]["is_high_velocity"] = True
    for members in groups[600].values():
        countries = {_country(rows[i][2]) for i in members}
        declined = sum(1 for i in members if rows[i][3] == "DECLINED")
        for i in members:
            out[i]["is_cross_border"] = len(countries) > 1
            out[i]["is_high_decline_rate"] = declined / len(members) > 0.5
    return out


def _frame(payments_df, rows):
    data = []
    for i, (card, sec, location, auth, currency, amount) in enumerate(rows):
        ts = "not a time" if sec < 0 else (BASE + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")
        data.append(payment(tid=str(i), ts=ts, card=card, location=location, auth=auth, currency=currency,
                            amount=amount))
    return payments_df(data)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(payment_rows)
def test_window_strategies_equal_brute_force(payments_df, rows):
    df = _frame(payments_df, rows)
    expected = _expected(rows)
    flags = ["is_high_velocity", "is_cross_border", "is_high_decline_rate"]
    for strategy in ("join", "window", "broadcast"):
        got = enrich(df, DEFAULT_CONFIG.with_(window_strategy=strategy)).select("transaction_id", *flags).collect()
        assert len(got) == len(rows)
        for r in got:
            assert {f: r[f] for f in flags} == expected[int(r.transaction_id)], (strategy, r.transaction_id)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(payment_rows)
def test_quarantine_routes_every_row(payments_df, rows):
    routed = enrich(_frame(payments_df, rows), DEFAULT_CONFIG.with_(null_policy="quarantine"))
    counts = {r.route: r["count"] for r in routed.groupBy("route").count().collect()}
    assert "unrouted" not in counts and sum(counts.values()) == len(rows)
    assert counts.get("unparseable", 0) == sum(1 for r in rows if r[1] < 0)
