"""The entry module with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def _names(root):
    out = subprocess.run([sys.executable, "-B", "-c",
                          "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"],
                         cwd=root, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": root})
    assert out.returncode == 0, out.stderr
    return [set(line.split()) for line in out.stdout.strip().splitlines()]


def test_the_library_stands_without_the_operators(tmp):
    root = os.path.join(tmp, "bare")
    shutil.copytree(os.path.join(ROOT, "marquee"), os.path.join(root, "marquee"),
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), root)
    queries, sqls = _names(root)
    assert queries == sqls and not any(q.startswith("op") for q in queries) and "pipeline" not in queries
    assert queries == set(entry.registry.queries())


def test_a_broken_operator_is_not_swallowed(tmp):
    root = os.path.join(tmp, "broken")
    shutil.copytree(os.path.join(ROOT, "marquee"), os.path.join(root, "marquee"),
                    ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        path = os.path.join(ROOT, name)
        if os.path.exists(path):
            shutil.copy(path, root)
    if not (os.path.exists(os.path.join(root, "corpus_pipeline.py"))
            and os.path.isdir(os.path.join(root, "marquee", "llm"))):
        return  # nothing to break
    with open(os.path.join(root, "corpus_pipeline.py"), "a") as f:
        f.write("\nimport no_such_module\n")
    out = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__"], cwd=root,
                         capture_output=True, text=True, env={**os.environ, "PYTHONPATH": root})
    assert out.returncode and "no_such_module" in out.stderr
