"""The entry module imports without a session, also when pyspark comes from
``pyspark.zip`` as it does under spark-submit."""

import glob
import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print('NAMES', len(q), len(s))"


def _import(path: str) -> str:
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_HOME", "PYTHONPATH")} | {"PYTHONPATH": path}
    r = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    return r.stdout


def test_imports_without_session():
    n, sql = _import(ROOT).split("NAMES")[1].split()
    assert int(n) >= 53 and int(sql) >= 50


def test_imports_from_pyspark_zip():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = [os.path.join(lib, "pyspark.zip"), *glob.glob(os.path.join(lib, "py4j-*.zip"))]
    if not os.path.exists(zips[0]):
        import pytest

        pytest.skip("no pyspark.zip beside this pyspark")
    assert "NAMES" in _import(os.pathsep.join([*zips, ROOT]))
