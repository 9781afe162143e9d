"""The entry module without the optional subpackage or its libraries."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
for name in {blocked}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(sum(k.startswith("op") or k == "pipeline" for k in entry.queries()), len(entry.queries()) >= 37)
"""


def _run(*blocked):
    done = subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    return done.stdout.strip(), done.stderr


def test_entry_without_a_library_of_the_subpackage():
    out, warned = _run("xxhash")
    assert out == "0 True" and "without the queries of areacast.llm" in warned


def test_entry_without_the_subpackage():
    assert _run("areacast.llm")[0] == "0 True"
    assert _run("corpus_pipeline")[0] == "0 True"
