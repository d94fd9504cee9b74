"""The driver's contract, with and without the training-data package."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from loomspark import queries as Q
from loomspark.operators import pack

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_stands_alone(tmp_path):
    shutil.copytree(os.path.join(ROOT, "loomspark"), tmp_path / "loomspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout.split(" ", 1)
    assert int(out[0]) == len(Q.QUERIES) and out[1].strip() == "[]"


def test_what_the_package_lacks_is_an_error(tmp_path):
    """A third-party module that is missing doesn't drop the queries without a word."""
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; e.queries()"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=False)
    assert not os.path.isdir(os.path.join(ROOT, "loomspark", "llm")) or done.returncode and "zstandard" in done.stderr


def test_nothing_else_imports_the_package():
    for folder, _, names in os.walk(os.path.join(ROOT, "loomspark")):
        if "llm" not in folder.split(os.sep):
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "llm" not in f.read(), n


def test_memory_pack_equals_a_fold(spark):
    rows = Q.memory_pack(spark, "/root/testdata/sf0.01").collect()
    rows.sort(key=lambda r: (float(r.conversation_id) * 1000 + 0.5, r.conversation_id))
    assert [r.shard_no for r in rows] == pack.fold_pack((r["_bytes"] for r in rows), Q.SHARD_BYTES, 21)
