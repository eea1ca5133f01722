"""Registered text queries against their SQL, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from siltstone.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    numbers = {int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    duck = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    expected = duck.execute(ORACLE[key]).df()
    found = QUERIES[key](spark, SF_DIR).toPandas()[list(expected.columns)]
    order = list(expected.columns)
    left = found.sort_values(order).reset_index(drop=True)
    right = expected.sort_values(order).reset_index(drop=True)
    assert left.astype(object).where(left.notna(), None).to_dict() == right.astype(object).where(right.notna(), None).to_dict()
    whole = [c for c in order if expected[c].notna().all()]
    assert [str(t) for t in left[whole].dtypes] == [str(t) for t in right[whole].dtypes]
