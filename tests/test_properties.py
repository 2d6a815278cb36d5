"""Property tests: check() agrees with a plain-Python evaluation on random small frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from covenant import Rule, check

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
VALS = st.one_of(st.none(), st.integers(min_value=-5, max_value=15))
ROWS = st.lists(st.tuples(KEYS, VALS), min_size=0, max_size=40)


def py_flags(rows):
    seen, out = set(), []
    for i, (k, v) in enumerate(rows):
        failed = []
        if k is None:
            failed.append("k_nn")
        if v is not None and (v < 0 or v > 10):
            failed.append("v_rng")
        if k is not None and k not in ("a", "b"):
            failed.append("k_acc")
        if k is not None:
            if k in seen:
                failed.append("k_uq")
            seen.add(k)
        out.append((i, failed))
    return out


RULES = [
    Rule("k_nn", "k", "not_null"),
    Rule("v_rng", "v", "range", params={"min": 0, "max": 10}),
    Rule("k_acc", "k", "accepted_values", params={"values": ["a", "b"]}),
    Rule("k_uq", "k", "unique", order_by=("id",)),
]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_check_matches_python(spark, rows):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "id int, k string, v int")
    got = sorted((r.id, list(r._dq_failed_rules)) for r in check(df, RULES).select("id", "_dq_failed_rules").collect())
    assert got == py_flags(rows)
