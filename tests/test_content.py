"""Results that say something: no column of a registered query is the same in all rows, unless that is in the nature of the rows."""

from pathlib import Path

import duckdb
import pytest

from barloom.plans import events, sections, series, tables  # noqa: F401
from barloom.plans.registry import ORACLES

SF = "/root/testdata/sf0.01"
GRID = "the grid has all five keys at every hour"
FULL = "paths without all their hours are left out"
BOUND = "the bound that is violated"
#: Columns that are constant, and why.
CONSTANT = {
    "activity_report.tokens": GRID, "anchored_rows.key": "one key has an anchor with enough capitalisation", "around_acquisition.acquired_ts": "one acquisition time for all keys", "count_violations.low": BOUND, "count_violations.high": BOUND,
    "incomplete_hours.expected": BOUND, "path_summaries.n_points": FULL, "path_summaries.max_h": FULL, "path_summaries.is_full": FULL, "pegged_assets.n": GRID, "rank_correlations.n": GRID, "regime_trades.in_regime": "an entry needs the regime",
    "serving_contract.univ_n": GRID, "two_horizon_labels.full_entry": FULL, "two_horizon_labels.full_manage": FULL, "universe_statistics.univ_n": GRID, "validation_report.checked_rows": "the number of rows of the table that is checked",
    "varying_columns.cumret_24": GRID, "version_violations.n_version": "there are two versions", "versioned_members.rule_version": "the version that was asked for", "wrapped_assets.n": GRID,
}
#: Queries of one or two rows.
FEW = {"combined_strategies": "the events fill one month"}


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_columns_vary(db, name):
    """On the SQL twin, which has the query's rows."""
    found = db.sql(ORACLES[name])
    columns, rows = found.columns, found.fetchall()
    if name in FEW:
        assert 1 <= len(rows) <= 2
        return
    assert len(rows) >= 3
    constant = {f"{name}.{c}" for k, c in enumerate(columns) if len({str(r[k]) for r in rows}) == 1}
    assert constant == {c for c in CONSTANT if c.startswith(f"{name}.")}
