"""Every query of the catalog: against its SQL, or that it runs."""

import pytest
from oracle_check import connect, same

from malgeul.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
connection = connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    if name in oracle.SQL:
        same(spark, connection, catalog.QUERIES[name], oracle.SQL[name], SF)
    else:
        assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(oracle.SQL) <= set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_spans_invariants(spark):
    rows = catalog.p1_find_spans(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    last = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert texts[r["doc_id"]][r["start"] : r["end"]] == r["text"] and last.get(r["doc_id"], 0) <= r["start"] < r["end"]
        last[r["doc_id"]] = r["end"]
