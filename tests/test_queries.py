"""Every query of the library against its SQL."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from hexfield.plans import layers as L
from hexfield.plans import registry

from .conftest import SF


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def rows(df: pd.DataFrame) -> list[str]:
    def plain(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return None
        return int(x) if isinstance(x, float) and x == int(x) else round(x, 6) if isinstance(x, float) else x

    return sorted(repr(tuple(plain(x) for x in r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_against_sql(spark, con, name):
    got = registry.queries()[name](spark, SF).toPandas()
    assert rows(got) == rows(con.execute(registry.oracles()[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles())))
def test_without_sql(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_segments_of_every_order(spark):
    """The nearest distances against all segments, without Spark and SQL."""
    keys = pd.read_parquet(f"{SF}/orders.parquet", columns=["o_orderkey", "o_custkey"])
    assert L.segments(spark, SF).count() == len(keys)
    k = keys.o_orderkey.to_numpy()
    x1, y1, dx, dy = k * 7919 % 100000 * 1.0, k * 104729 % 100000 * 1.0, k % 7 * 300.0, k % 5 * 400.0
    length = dx * dx + dy * dy
    lines, high = {}, np.isin(keys.o_custkey.to_numpy() % 4, [1, 2])
    for c in pd.read_parquet(f"{SF}/customer.parquet", columns=["c_custkey"]).c_custkey.tolist():
        x, y = c * 7919 % 100000, c * 104729 % 100000
        t = np.where(length > 0, np.clip(((x - x1) * dx + (y - y1) * dy) / np.maximum(length, 1), 0, 1), 0)
        d2 = (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2
        lines[c] = d2.min() ** 0.5 * 100, d2[high].min() ** 0.5
    for name, i in (("nearest_segment", 0), ("job_lines", 1)):
        got = {int(r[0]): r[1] for r in registry.queries()[name](spark, SF).collect()}
        assert got.keys() == lines.keys() and all(abs(got[c] - lines[c][i]) < 0.51 for c in lines)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 20
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
