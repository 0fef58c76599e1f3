"""The entry's guard: without the text operators all other queries are there."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(blocked):
    """Query names of a fresh interpreter in which some modules cannot be imported."""
    code = f"""
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {blocked!r} or name in {blocked!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(n.startswith("op") for n in entry.queries()), "pipeline" in entry.queries())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    many, oracles, numbered, pipeline = done.stdout.split()
    return int(many), int(oracles), numbered == "True", pipeline == "True"


def test_other_queries_are_there_without_the_text_operators():
    for blocked in (["millrace.llm", "corpus_pipeline"], ["xxhash"], ["millrace.llm"]):
        many, oracles, numbered, pipeline = names(blocked)
        assert many == oracles >= 50 and not numbered and not pipeline
