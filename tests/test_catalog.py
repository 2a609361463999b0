"""Every registered query against its DuckDB statement on the smallest given tables."""

import os
import subprocess
import sys

import pytest

from reviewloom.plans.catalog import registered

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
def test_queries_match_their_statements(spark):
    from verification.compare import compare, connect

    report = compare(spark, connect(SF), SF, list(registered()))
    assert {n: r for n, r in report.items() if not r.startswith(("same", "rows only"))} == {}
    assert not [n for n, r in report.items() if r.startswith("rows only")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
def test_dictionaries_beyond_the_broadcast_size(spark, monkeypatch):
    """The same results when nothing may be broadcast but the heaviest keys."""
    from reviewloom.operators import lookups, validate
    from reviewloom.session import forget_stages
    from verification.compare import compare, connect

    for function in (lookups.lookup, lookups.fits_broadcast, validate.with_first_occurrence):
        monkeypatch.setattr(function, "__defaults__", (0,))
    monkeypatch.setattr(lookups, "HOT_KEYS", 20)
    forget_stages()
    report = compare(spark, connect(SF), SF, ["validation_flags", "reason_records", "synonym_tokens"])
    forget_stages()
    assert all(r.startswith("same") for r in report.values()), report


def test_modules_load_without_a_session():
    code = "import __spark_entry__ as e; assert e.queries().keys() >= e.oracle_sql().keys()"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_every_query_has_a_statement():
    from verification.statements import STATEMENTS

    assert registered().keys() == STATEMENTS.keys()
