"""Driver contract: entry, queries and oracle keys."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["content", "rank", "accession_number", "chunk_index", "metadata"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
