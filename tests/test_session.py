import importlib
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from folioframe import session

ROOT = Path(__file__).resolve().parent.parent


def test_cut_lineage_writes_into_the_runs_folder(spark):
    df = session.cut_lineage(spark.range(5))
    assert df.count() == 5
    folder = session.shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir") in folder and os.path.isdir(folder.removeprefix("file:"))


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    class Context:
        applicationId, master = "other", "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Session())


def test_the_core_stands_without_the_llm_subpackage(tmp_path):
    shutil.copytree(ROOT / "folioframe", tmp_path / "folioframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n[0] == 'p' and n[1].isdigit() and n[1] != '3']; assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True).returncode == 0


def test_every_query_with_sql_has_a_query():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
