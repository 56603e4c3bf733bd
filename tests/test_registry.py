"""Every registered query has oracle SQL unless it is on the documented rows-only list."""

from lotmarket.plans import catalog

ROWS_ONLY = {"rf_fit", "gbt_fit", "gbt_importance", "file_fingerprint", "file_range_print"}


def test_oracle_coverage():
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    assert set(qs) - set(sqls) == ROWS_ONLY
    assert set(sqls) <= set(qs)


def test_no_reserved_names():
    # names the task rules out for query keys
    assert not any(k.startswith("op") and k[2:3].isdigit() for k in catalog.queries())
    assert "pipeline" not in catalog.queries()
