"""The entry module with and without the operators on documents."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WITHOUT = """
import sys

class Without:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["voxtable", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Without())
import __spark_entry__ as entry
assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries()), entry.queries()
assert set(entry.oracle_sql()) <= set(entry.queries())
print(len(entry.queries()))
"""


def test_the_rest_works_without_the_subpackage():
    run = [sys.executable, "-c", WITHOUT]
    done = subprocess.run(run, cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 50


def test_other_import_errors_show():
    broken = WITHOUT.split("sys.meta_path")[0].replace(
        'name.split(".")[:2] == ["voxtable", "llm"] or name == "corpus_pipeline"', 'name == "numpy"'
    )
    run = [sys.executable, "-c", broken + "sys.meta_path.insert(0, Without())\nimport __spark_entry__"]
    assert subprocess.run(run, cwd=ROOT, capture_output=True, timeout=120).returncode != 0
