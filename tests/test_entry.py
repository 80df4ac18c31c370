"""The entry module with and without what the llm subpackage needs."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys, importlib.abc
class Block(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
q = e.queries()
print(len([n for n in q if n in e.LLM_QUERIES]), len([n for n in q if n not in e.LLM_QUERIES]), len(e.oracle_sql()))
for n in e.LLM_QUERIES:
    if n in q:
        try:
            q[n](None, "x")
        except ModuleNotFoundError as error:
            print("missing", error.name)
        except Exception:
            print("other")
        break
"""


def run(names):
    out = subprocess.run([sys.executable, "-c", CODE.format(names=names)], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert out.returncode == 0, out.stderr[-800:]
    return out.stdout.split("\n")


def test_without_the_subpackage():
    first = run(("strandline.llm", "corpus_pipeline"))[0].split()
    assert first[0] == "0" and int(first[1]) >= 146 and first[1] == first[2]


def test_without_a_library_of_the_subpackage():
    lines = run(("xxhash",))
    if not (ROOT / "strandline" / "llm").exists():
        return
    assert lines[0].split()[0] == "14" and int(lines[0].split()[1]) >= 146
    assert lines[1] == "missing xxhash"
