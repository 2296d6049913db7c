"""The entry point without its optional parts."""
import subprocess
import sys

CODE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {names}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert len(q) >= 43 and set(q) == set(o), sorted(set(q) ^ set(o))
"""


def test_base_queries_need_no_library_of_the_others():
    for names in (["xxhash"], ["railpulse.llm", "corpus_pipeline"]):
        subprocess.run([sys.executable, "-c", CODE.replace("{names}", repr(names))], check=True, cwd=".")
