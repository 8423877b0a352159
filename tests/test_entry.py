"""The entry module in copies of the repository without the operators of documents."""

import json
import os
import pathlib
import shutil
import subprocess
import sys

import pytest

from envflow import catalog

ROOT = pathlib.Path(__file__).parent.parent
SHOW = """import json, sys, __spark_entry__ as e
own = [m.__file__ for n, m in sys.modules.items() if n.split(".")[0] in ("envflow", "corpus_pipeline", "__spark_entry__") and getattr(m, "__file__", None)]
print(json.dumps({"queries": sorted(e.queries()), "oracles": sorted(e.oracle_sql()), "files": own}))"""


def shown(copy):
    """What the entry module of a copy of the repository has; nothing but the copy may be imported."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    found = json.loads(ran.stdout.splitlines()[-1])
    assert all(pathlib.Path(f).is_relative_to(copy) for f in found["files"]), found["files"]
    return set(found["queries"]), set(found["oracles"])


@pytest.fixture
def copy(tmp_path):
    return pathlib.Path(shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", "tests")))


@pytest.mark.parametrize("gone", [["envflow/llm"], ["envflow/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_operators(copy, gone):
    there = (copy / "envflow/llm").exists()
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    queries, oracles = shown(copy)
    more = queries - set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= queries and set(catalog.ORACLES) <= oracles and "pipeline" not in queries
    assert bool(more) == (there and "envflow/llm" not in gone) and all(n.startswith("op") for n in more)


@pytest.mark.skipif(not (ROOT / "envflow/llm").exists(), reason="the operators are absent")
def test_entry_where_a_dependency_of_the_operators_is_missing(copy):
    path = copy / "envflow/llm/queries.py"
    path.write_text(path.read_text() + "\nimport a_module_that_is_not_there\n")
    queries, oracles = shown(copy)
    assert queries == set(catalog.QUERIES) and oracles == set(catalog.ORACLES)
