"""Registration with and without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__
from workload.oracles import ORACLES
from workload.queries import REGISTRY

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_twin_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(REGISTRY) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("left", [[], ["corpus_pipeline.py"], ["tapflow/llm"], ["tapflow/llm", "corpus_pipeline.py"]])
def test_other_queries_stay_when_optional_parts_are_gone(tmp_path, left):
    optional = ["tapflow/llm", "corpus_pipeline.py"]
    for name in ["__spark_entry__.py", "tapflow", "workload", *(x for x in left if "/" not in x)]:
        source = os.path.join(ROOT, name)
        if not os.path.exists(source):
            pytest.skip(f"{name} is not here")
        if os.path.isdir(source):
            gone = None if "tapflow/llm" in left else shutil.ignore_patterns("llm")
            shutil.copytree(source, tmp_path / name, ignore=gone)
        else:
            shutil.copy(source, tmp_path / name)
    if any(not os.path.exists(os.path.join(ROOT, x)) for x in left):
        pytest.skip("an optional part is not here")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries(), any(x.startswith('op1_') for x in e.queries()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert said.returncode == 0, said.stderr
    n, twins, pipeline, operators = said.stdout.split()[-4:]
    assert int(n) >= len(REGISTRY) and int(twins) >= len(ORACLES)
    assert pipeline == str(left == optional) and operators == str("tapflow/llm" in left)
