from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import os

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    from tallyweir.session import get_spark

    s = get_spark("tests", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    """Columns in order of name, and rows in order of value, for comparing two engines' results."""
    import pandas as pd

    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        return repr(round(float(v), 6)) if isinstance(v, float) else str(v)

    names = sorted(frame.columns)
    return names, sorted(tuple(plain(v) for v in r) for r in frame[names].itertuples(index=False))
