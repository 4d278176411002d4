"""The driver's entry works with and without the optional parts."""

import os
import subprocess
import sys
import textwrap

import pytest

from roadflow import registry



ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["roadflow.llm", "roadflow.llm.queries", "corpus_pipeline", "xxhash"])
def test_the_other_queries_stay_when_a_part_cannot_be_imported(missing):
    code = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        sys.modules[{missing!r}] = None  # importing it raises ImportError
        import __spark_entry__ as entry
        print(len(entry.queries()), len(entry.oracle_sql()), "op1_exact_dedup" in entry.queries(), "pipeline" in entry.queries())
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, check=True)
    n, sql, operators, pipeline = out.stdout.split()[-4:]
    assert int(n) >= len(registry.queries()) and int(sql) >= len(registry.oracle_sql())
    assert pipeline == "False"
    assert "left out" in out.stderr


def test_every_query_of_the_library_has_its_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
