"""Every registered query of the dataset operators against its DuckDB SQL at the smallest scale."""

import duckdb
import pandas as pd
import pytest

from polyglotmill.plans import registry
import polyglotmill.plans  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame, columns):
    def text(v):
        if v is None or pd.isna(v):
            return "~"
        if "bool" in type(v).__name__ or isinstance(v, str):
            return str(v)
        return repr(round(float(v), 6))

    return sorted("|".join(text(v) for v in r) for r in frame[columns].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = duck.sql(registry.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)
