"""Property test: annotate() against a brute-force Python model of the rule
semantics on small generated frames (nulls, duplicates, blanks, edge
numbers).  Reason order, set semantics, NULL-passes-except-NOT_NULL and
UNIQUE-rejects-every-copy are all checked row by row."""

import datetime as dt
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.functions.rules import Rule
from salesmart.operators.quality import annotate

RULES = [
    Rule("NOT_NULL", "k", "K_MISSING"),
    Rule("UNIQUE", "k", "K_DUPLICATE"),
    Rule("REGEX", "k", "K_FORMAT", "^[A-C]{2}-[0-9]$"),
    Rule("ALLOWED_VALUES", "mode", "MODE_BAD", '["x","y"]'),
    Rule("POSITIVE", "q", "Q_NOT_POSITIVE"),
    Rule("BETWEEN", "d", "D_RANGE", '{"min":0,"max":1}'),
    Rule("COLUMN_GTE", "ship", "SHIP_EARLY", "day"),
    Rule("NOT_NULL", "mode", "MODE_MISSING"),
    Rule("NOT_NULL", "k", "K_MISSING"),  # repeated reason: kept once, first position
]

keys = st.one_of(st.none(), st.sampled_from(["AB-1", "CA-9", "AB-1", "ab-1", "ZZ-1", "AB-12", "CC-0"]))
modes = st.one_of(st.none(), st.sampled_from(["x", "y", "X", "z"]))
nums = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.5, 1.0, 1.5, 2.0]))
days = st.one_of(st.none(), st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 1, 5)))
rows = st.lists(st.tuples(keys, modes, nums, nums, days, days), min_size=1, max_size=25)


def model(data):
    counts = Counter(r[0] for r in data if r[0] is not None)
    out = []
    for k, mode, q, d, day, ship in data:
        checks = {
            "K_MISSING": k is not None,
            "K_DUPLICATE": k is None or counts[k] == 1,
            "K_FORMAT": k is None or re.search(r"^[A-C]{2}-[0-9]$", k) is not None,
            "MODE_BAD": mode is None or mode in ("x", "y"),
            "Q_NOT_POSITIVE": q is None or q > 0,
            "D_RANGE": d is None or 0 <= d <= 1,
            "SHIP_EARLY": ship is None or day is None or ship >= day,
            "MODE_MISSING": mode is not None,
        }
        reasons = []
        for rule in RULES:
            if not checks[rule.failure_reason] and rule.failure_reason not in reasons:
                reasons.append(rule.failure_reason)
        out.append(((k, mode, q, d, day, ship), reasons))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_annotate_matches_python_model(spark, data):
    df = spark.createDataFrame(data, "k string, mode string, q double, d double, day date, ship date")
    got = [((r["k"], r["mode"], r["q"], r["d"], r["day"], r["ship"]), r["dq_failure_reasons"], r["dq_status"])
           for r in annotate(df, RULES).collect()]
    want = model(data)
    key = lambda t: repr(t[0]) + repr(t[1])
    assert sorted(((g[0], g[1]) for g in got), key=key) == sorted(want, key=key)
    assert all((g[2] == "PASSED") == (not g[1]) for g in got)
