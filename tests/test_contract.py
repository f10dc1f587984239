"""The repository stands without the training-data folders, and its own modules alone are on the executors' path."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_imports_without_the_llm_folders(tmp_path):
    keep = shutil.ignore_patterns(".git", "__pycache__", "llm", ".pytest_cache")
    for pipeline in (True, False):
        copy = tmp_path / f"copy-{pipeline}"
        shutil.copytree(ROOT, copy, ignore=keep)
        if not pipeline and (copy / "corpus_pipeline.py").exists():
            (copy / "corpus_pipeline.py").unlink()
        code = "import __spark_entry__ as e; q = e.queries(); assert 'cluster_rollup' in q and 'pipeline' not in q and not [k for k in q if k.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
        # what else the environment offers stays; this repository itself doesn't
        paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.realpath(p) != os.path.realpath(ROOT)]
        env = os.environ | {"PYTHONPATH": os.pathsep.join(paths), "PYTHONDONTWRITEBYTECODE": "1"}

        def run(*command):
            done = subprocess.run([sys.executable, *command], cwd=copy, env=env, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True)
            assert done.returncode == 0, done.stdout[-4000:]

        run("-c", code)
        run("-m", "pytest", "-p", "no:cacheprovider", "--collect-only", "-q", "tests")
        if not pipeline:
            run("-m", "pytest", "-p", "no:cacheprovider", "-q", "tests/test_functions.py")


def test_test_modules_have_names_of_their_own():
    names = [f for _, _, files in os.walk(os.path.join(ROOT, "tests")) for f in files if f.startswith("test_")]
    assert len(names) == len(set(names))


def test_staged_tables_can_be_deleted(spark):
    from lodestream.plans.staging import forget, shared_dir, staged

    t = staged(spark.range(5), "kept")
    assert t.count() == 5 and os.path.isdir(f"{shared_dir(spark)}/tables")
    forget(spark)
    assert not os.path.isdir(f"{shared_dir(spark)}/tables")
