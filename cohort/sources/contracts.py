"""Schema and key contract check (S6), re-aimed from the reference's table
manifest: instead of writing a manifest, verify it.

One aggregate per table (rows, distinct keys, rows with a null key part),
unioned into a long result; ``schema_ok`` compares the DataFrame's schema
with the declared contract (names and types, nullability ignored).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort.sources.tables import CONTRACTS, KEYS


def schema_matches(df: DataFrame, contract: T.StructType) -> bool:
    have = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in contract.fields]
    return have == want


def contract_check(tables: dict[str, DataFrame]) -> DataFrame:
    """``[table, rows, distinct_keys, null_key_rows, key_unique, schema_ok]`` per table."""
    parts = []
    for name in sorted(tables):
        df = tables[name]
        keys = KEYS[name]
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        agg = df.agg(F.count(F.lit(1)).alias("rows"),
                     F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"),
                     F.count_if(any_null).alias("null_key_rows"))
        ok = schema_matches(df, CONTRACTS[name])
        parts.append(agg.select(F.lit(name).alias("table"), "rows", "distinct_keys", "null_key_rows",
                                ((F.col("rows") == F.col("distinct_keys")) & (F.col("null_key_rows") == 0))
                                .alias("key_unique"),
                                F.lit(ok).alias("schema_ok")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
