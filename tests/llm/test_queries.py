"""The queries, their SQL and the pipeline on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from panelflow.llm.oracles import ORACLE_SQL
from panelflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    problems, rows, _ = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF_SMALL, duck(SF_SMALL))
    assert rows and not problems, problems


def test_entry_lists_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert sum(n.startswith("op") for n in QUERIES) == 13 and "pipeline" in QUERIES


@pytest.mark.parametrize("name", ["op1_line_dedup", "op5_quality", "op6_pii"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_pipeline(spark, tmp_path):
    """Each stage on its own input: what it must drop goes, everything else stays."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first, before = docs.columns, None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "encoding"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        path = str(tmp_path / str(k))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count()
        if name != "encoding":
            assert docs.columns == first
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
            clean = [k for k in before if labels.get(k) == 0]
            assert sum(k in after for k in clean) >= 0.9 * len(clean)
        elif name == "line dedup":
            for k, (_, _, _, text) in brute.lines(sorted((k, r.text) for k, r in before.items())).items():
                assert after[k].text == text and after[k].n_chars == len(text)
        elif name == "near dedup":
            roots = brute.components({k: brute.fingerprint(r.text) for k, r in before.items()})
            assert set(after) == set(roots.values())
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            assert set(after) == {k for k, r in before.items() if not brute.contamination(r.text, items)[1]}
        else:
            assert set(after) == set(before)
            assert all(after[k].decoded_sha256 == brute.sha(before[k].text) for k in after)


def test_the_rest_imports_without_this_layer(tmp_path):
    """A copy of the repository without the layer still imports and lists its other queries."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; print(len(q))"
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert r.returncode == 0, r.stderr
