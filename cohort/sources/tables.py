"""Table contracts and readers.

Ids may be strings or whole numbers in any table; other columns have one declared
type and are cast to it. A missing required column raises, a missing
optional one is null.

Inputs are Parquet tables ``{prefix}/{name}.parquet``; ``prefix`` is any Hadoop
file-system URI (local path, ``hdfs://``, ``s3a://``), so no branching on the
scheme is needed. A drifted input fails when it is read instead of deep inside a job.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, D, S, B, I = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Logical inputs of the engine (see FIXTURES.md section 1).
CONTRACTS: dict[str, T.StructType] = {
    "persons": _schema(("person_id", L), ("true_segment", L), ("age", D), ("income_z", D),
                       ("recency_days", D), ("converted_true", I), ("region", S),
                       ("gdpr_consent", B), ("ccpa_opt_out", B)),
    "devices": _schema(("device_id", L), ("person_id", L), ("device_type", S)),
    "identity_signals": _schema(("device_id", L), ("signal_type", S), ("signal_value", S)),
    "events": _schema(("event_id", S), ("device_id", L), ("content_cat", S), ("campaign", S), ("creative", I),
                      ("position", I), ("bid", D), ("click", I)),
    "interactions": _schema(("person_id", L), ("content_cat", S), ("weight", L),
                            ("impressions", L)),
    "campaign_stream": _schema(("round", L), ("batch", T.DateType()), ("creative", S),
                               ("reward", I)),
}

# Columns that may be missing, and columns that are used if they are there.
OPTIONAL = {"events": {"event_id"}, "campaign_stream": {"batch"}, "persons": {"true_segment"}}
EXTRA = {"persons": {"processing_allowed": B}, "events": {"convert": I}}
IDS = {"person_id", "device_id", "event_id"}
# Rounds of one batch where the stream names none.
BATCH_ROUNDS = 500

# Natural keys, used by the contract check.
KEYS: dict[str, list[str]] = {
    "events": ["event_id"],
    "persons": ["person_id"],
    "devices": ["device_id"],
    "identity_signals": ["device_id", "signal_type", "signal_value"],
    "interactions": ["person_id", "content_cat"],
    "campaign_stream": ["round"],
}


def table_path(prefix: str, name: str) -> str:
    return f"{prefix.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, prefix: str, name: str,
               contract: T.StructType | None = None) -> DataFrame:
    """Read ``{prefix}/{name}.parquet``; with a contract, read with that schema."""
    reader = spark.read
    if contract is not None:
        reader = reader.schema(contract)
    return reader.parquet(table_path(prefix, name))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of the contract, in its order and types, and known extra ones.

    Ids keep a string type and become bigint otherwise. A stream without ``batch`` gets
    batches of ``BATCH_ROUNDS`` rounds.
    """
    contract, optional = CONTRACTS[name], OPTIONAL.get(name, set())
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in contract.fields if f.name not in have and f.name not in optional]
    if missing:
        raise ValueError(f"table {name}: missing column(s) {', '.join(missing)}")

    def column(field: T.StructField):
        if field.name not in have:
            if field.name == "batch":
                return F.floor(F.col("round") / BATCH_ROUNDS).cast("long").alias("batch")
            return F.lit(None).cast(field.dataType).alias(field.name)
        kind = field.dataType
        if field.name in IDS:
            kind = S if isinstance(have[field.name], T.StringType) else kind if kind == S else L
        if field.name == "batch":
            kind = have["batch"]
        return F.col(field.name).cast(kind).alias(field.name)

    extra = [F.col(n).cast(t) for n, t in EXTRA.get(name, {}).items() if n in have]
    return df.select(*map(column, contract.fields), *extra)


def read_logical(spark: SparkSession, prefix: str, name: str) -> DataFrame:
    """Read one of the engine's logical tables and bring it to its declared contract."""
    return conform(read_table(spark, prefix, name), name)
