"""Property tests: exact NOT IN, Python-strip blank test, date layouts."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelflow.functions.columns import date_key
from panelflow.operators.keys import new_keys
from panelflow.operators.reconcile import non_blank_lines

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.lists(st.one_of(st.none(), st.integers(-3, 6)), max_size=8)


@SETTINGS
@given(src=keys, tgt=keys)
def test_new_keys_is_not_in(spark, src, tgt):
    s = spark.createDataFrame([(k, i) for i, k in enumerate(src)], "k int, i int")
    t = spark.createDataFrame([(k,) for k in tgt], "t int")
    got = sorted(r.i for r in new_keys(s, t, "k", "t").collect())
    if not tgt:
        want = list(range(len(src)))
    elif None in tgt:
        want = []
    else:
        want = [i for i, k in enumerate(src) if k is not None and k not in tgt]
    assert got == want


WS = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", " ", "\x85", "\xa0", "\u2003", "\u3000", "\u200b"]


@SETTINGS
@given(lines=st.lists(st.text(alphabet=st.sampled_from(WS + ["a", "é", "-"]), max_size=5), max_size=10))
def test_blank_lines_follow_python_strip(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert non_blank_lines(df).count() == sum(1 for x in lines if x.strip() != "")


@SETTINGS
@given(d=st.dates(min_value=dt.date(1971, 1, 1), max_value=dt.date(2099, 12, 31)))
def test_date_layouts_round_trip(spark, d):
    df = spark.createDataFrame([(d.strftime("%Y_%m_%d"),)], "d string")
    r = df.select(date_key("d", "yyyyMMdd'T'000000'Z'", frm="yyyy_MM_dd").alias("s"),
                  date_key("d", "yyyyMMdd'T'000000'Z'", frm="yyyy_MM_dd", days=1).alias("e"),
                  date_key("d", "yyyy-MM-dd", frm="yyyy_MM_dd").alias("iso")).first()
    assert r.s == d.strftime("%Y%m%dT000000Z")
    assert r.e == (d + dt.timedelta(days=1)).strftime("%Y%m%dT000000Z")
    assert r.iso == d.isoformat()
