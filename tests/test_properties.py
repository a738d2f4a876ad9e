"""Generated histories: both change modes against row-by-row replays."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronoset.operators import scd2
from test_scd2 import TRACKED, _replay_append_all, _replay_changed_only, build, daily, fold_step, rows_of

DAYS = [dt.date(2025, 2, i) for i in range(1, 7)]

row = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.sampled_from(DAYS),
    st.sampled_from(["A", "B", None]),
    st.sampled_from(["X", "Y", None]),
    st.sampled_from(["n", "m"]),
)
# one row per (key, day), as the daily reduction guarantees
histories = st.lists(row, min_size=1, max_size=14, unique_by=lambda r: (r[0], r[1]))
PROFILE = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@PROFILE
@given(rows=histories)
def test_changed_only_equals_replay(spark, rows):
    assert rows_of(build(spark, rows)) == _replay_changed_only(rows)


@PROFILE
@given(rows=histories)
def test_append_all_equals_replay(spark, rows):
    assert rows_of(build(spark, rows, scd2.APPEND_ALL)) == _replay_append_all(rows)


@PROFILE
@given(rows=histories)
def test_fold_one_plan_equals_loop(spark, rows):
    dl = daily(spark, rows)
    one = scd2.fold_days(scd2.empty_dimension(dl, "k", "day"), dl, "k", "day", TRACKED)
    assert rows_of(one) == rows_of(fold_step(spark, rows))
