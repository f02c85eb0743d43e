"""The driver contract works from any working directory with a plain session."""

import os
import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF_SMALL


def test_entry_and_python_worker_code_from_elsewhere(tmp_path):
    script = textwrap.dedent(f"""
        import importlib.util
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]")
                 .config("spark.sql.session.timeZone", "America/New_York")
                 .config("spark.ui.enabled", "false").getOrCreate())
        spec = importlib.util.spec_from_file_location("e", "{ROOT}/__spark_entry__.py")
        e = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(e)
        assert all(r.matched for r in e.entry(spark).collect())
        # the archive extractor runs in Python workers that cannot import the package
        assert e.queries()["archive_members"](spark, "{SF_SMALL}").count() == 1000
        print("OK")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.stdout.strip().endswith("OK"), r.stderr[-2000:]


def test_top_level_api_resolves():
    import panelflow
    assert all(callable(getattr(panelflow, name)) for name in panelflow._API)
    assert set(panelflow._API) <= set(dir(panelflow))


def test_the_entry_survives_a_missing_library_of_the_training_data_layer():
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); assert 'reconcile' in q and not any(k.startswith('op') for k in q)"
    r = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert r.returncode == 0, r.stderr[-800:]
