import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [True, False], ids=["with the pipeline's file", "without it"])
def test_entry_works_without_the_pipeline_package(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "tripmill", copy / "tripmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", copy)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.OWN), len(e.oracle_sql()))"],
        cwd=copy, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120,
    )
    assert said.returncode == 0, said.stderr
    assert said.stdout.split()[0] == "True" and int(said.stdout.split()[1]) > 0
