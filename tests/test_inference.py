"""Header-feed type inference agrees with pandas' read_csv (the reference's reader)."""

import io
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelflow.sources.header import read_snapshot

KINDS = {
    "int": st.sampled_from(["0", "7", "-3", "+5", "00012", "123456789"]),
    "float": st.sampled_from(["1.5", "-0.25", "2.0", ".5", "5.", "1e3", "inf"]),
    "bool": st.sampled_from(["True", "False", "TRUE", "false"]),
    "text": st.sampled_from(["abc", "1d", "0x10", "1_000", "x y", "tRuE", " true", "yes", "é"]),
}
PANDAS_TO_SPARK = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}


def _column(kind_pool):
    return st.lists(st.one_of(*kind_pool), min_size=1, max_size=5)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cols=st.lists(st.lists(st.sampled_from(list(KINDS)), min_size=1, max_size=2), min_size=1, max_size=3),
       data=st.data())
def test_types_and_values_match_pandas(spark, tmp_path_factory, cols, data):
    n = data.draw(st.integers(1, 4))
    table = {f"c{j}": [data.draw(st.one_of(*[KINDS[k] for k in kinds])) for _ in range(n)]
             for j, kinds in enumerate(cols)}
    text = "\t".join(table) + "\n" + "".join("\t".join(table[c][i] for c in table) + "\n" for i in range(n))
    path = tmp_path_factory.mktemp("inf") / "snap.tsv"
    path.write_text(text)
    want = pd.read_csv(io.StringIO(text), sep="\t")
    got = read_snapshot(spark, str(path))
    assert dict(got.dtypes) == {c: PANDAS_TO_SPARK[str(want[c].dtype)] for c in want.columns}
    rows = got.collect()
    for c in want.columns:
        for i in range(n):
            a, b = rows[i][c], want[c][i]
            if isinstance(b, float):
                assert (math.isinf(a) and math.isinf(b)) or a == b
            else:
                assert a == (b.item() if hasattr(b, "item") else b)


def test_compact_dates_like_pandas(spark):
    from panelflow.functions.columns import parse_compact_date
    vals = ["20230517", "2023517", "202305 7", "20230230", "20231301", "bad", "20230517.0", "19991231",
            "2023-05-17", " 20230517", "202305170", "00010101", "22620411", "22620412", "16770922"]
    want = pd.to_datetime(pd.Series(vals, dtype=object), format="%Y%m%d", errors="coerce")
    df = spark.createDataFrame([(v,) for v in vals], "a string")
    got = [r.d for r in parse_compact_date(df, "a", "d").collect()]
    assert got == [None if pd.isna(w) else w.date() for w in want]
