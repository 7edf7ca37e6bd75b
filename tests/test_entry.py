"""The entry module, with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_operators(tmp_path):
    ignore = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=ignore)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'm11_hourly_slots' in q and set(s) <= set(q) and not any(k.startswith('op') for k in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, check=True)


def test_every_sql_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_corpus_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "gridmix")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "gridmix.llm" not in f.read(), name


def test_flagship(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "heure_utc" in df.columns
