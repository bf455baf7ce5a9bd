"""The driver contract in __spark_entry__.py."""
import __spark_entry__ as entry


def test_entry_runs_flagship_on_sf0001(spark):
    df = entry.entry(spark)
    assert df.columns == ["tp", "predicted_pairs", "true_pairs", "precision", "recall", "f1"]
    r = df.collect()
    assert len(r) == 1 and r[0].precision == 1.0 and r[0].tp == 1696


def test_every_oracle_has_a_query_and_names_are_stable():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 63 and len(sql) >= 48
    assert all(callable(f) for f in q.values())
