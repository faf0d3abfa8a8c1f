"""The entry file where parts of the repository, or packages, are absent."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_BLOCK = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if any(name == n or name.startswith(n + '.') for n in {names!r}):
            raise ModuleNotFoundError(f'No module named {{name!r}}', name=name)
sys.meta_path.insert(0, Absent())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
names = list(e.queries())
assert set(e.oracle_sql()) <= set(names)
assert not any(n.startswith('op') or n == 'pipeline' for n in names), names
print(len(names))
"""


def test_other_queries_load_without_the_text_operators():
    counts = set()
    for names in (["zerotally.llm", "corpus_pipeline"], ["zstandard"], ["tokenizers", "tiktoken", "zstandard", "xxhash"]):
        code = _BLOCK.format(names=names, root=ROOT)
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=ROOT)
        assert done.returncode == 0, done.stderr
        counts.add(int(done.stdout))
    assert len(counts) == 1 and counts.pop() > 130
