"""The driver's entry with parts of the training-data subpackage absent."""

import json
import subprocess
import sys

from conftest import ROOT

from testbed.oracle import all_oracles
from testbed.queries import all_queries

REPORT = """
import json
import __spark_entry__ as driver
print(json.dumps([sorted(driver.queries()), sorted(driver.oracle_sql())]))
"""


def run(before: str) -> subprocess.CompletedProcess:
    return subprocess.run(
        [sys.executable, "-c", before + REPORT], cwd=ROOT, capture_output=True, text=True, timeout=300
    )


def check_kpi_part(done: subprocess.CompletedProcess) -> None:
    assert done.returncode == 0, done.stderr
    queries, oracles = json.loads(done.stdout.splitlines()[-1])
    assert set(all_queries()) <= set(queries) and set(all_oracles()) <= set(oracles)
    assert not [q for q in queries if q.startswith("op")] and "pipeline" not in queries


def test_a_missing_library_leaves_the_kpi_queries():
    done = run("import sys; sys.modules['xxhash'] = None\n")
    check_kpi_part(done)
    assert "left out saldero.llm" in done.stderr


def test_a_missing_subpackage_leaves_the_kpi_queries():
    done = run("import sys; sys.modules['saldero.llm'] = None\n")
    check_kpi_part(done)


def test_errors_of_our_own_code_are_raised():
    done = run("import sys; sys.modules['saldero.session'] = None\n")
    assert done.returncode != 0 and "saldero.session" in done.stderr
    broken = "import sys, types; sys.modules['saldero.llm.frames'] = types.ModuleType('saldero.llm.frames')\n"
    done = run(broken)
    missing = "saldero.llm" in done.stderr and "left out saldero.llm" not in done.stderr
    assert (done.returncode != 0 and missing) or not (ROOT / "saldero/llm/frames.py").exists()
