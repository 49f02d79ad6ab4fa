import pathlib
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent

PROGRAM = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == sys.argv[1]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Missing())
sys.path.insert(0, sys.argv[2])
import __spark_entry__ as driver

print(len(driver.queries()) == len(driver.oracle_sql()) == len(driver.QUERIES) > 46, not driver.LLM_QUERIES)
"""


@pytest.mark.parametrize("name", ["corpus_pipeline", "tidewright.llm", "tidewright.llm.merkle", "tokenizers"])
def test_core_queries_without_training_data(name):
    done = subprocess.run([sys.executable, "-c", PROGRAM, name, str(ROOT)], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr[-1000:]


def test_other_import_errors_are_raised():
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM, "tidewright.sources.tables", str(ROOT)], capture_output=True, text=True, timeout=120
    )
    assert done.returncode != 0 and "tidewright.sources.tables" in done.stderr
