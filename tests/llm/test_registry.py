import os
import re
import shutil
import subprocess
import sys

import __spark_entry__
import corpus_pipeline

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


def test_one_query_for_each_operator_and_the_pipeline():
    names = __spark_entry__.queries()
    assert sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))) == list(range(1, 11))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_the_rest_stands_without_this_part(tmp_path):
    shutil.copytree(os.path.join(ROOT, "gapweave"), tmp_path / "gapweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert n and set(n) == set(e.oracle_sql()); assert not any(x.startswith('op') for x in n)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=60)


def test_nothing_else_imports_this_part():
    for folder, _, files in os.walk(os.path.join(ROOT, "gapweave")):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py") and "/llm/" not in folder:
                with open(os.path.join(folder, name)) as file:
                    assert "gapweave.llm" not in file.read(), name
