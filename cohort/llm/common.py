"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.session import ensure_checkpoint_dir

# Bytes of an Arrow batch, and the session's setting for it.
BATCH_BYTES = 8 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Size of the bitmaps of hashed ids that tasks filter by, 4 MB whatever the number of ids.
BITMAP_BITS = 1 << 25

# Bytes of text handled at once inside a task: longer texts are cut between words.
SECTION_BYTES = 4 << 20


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select columns by exact name as ``alias=name``; the first wins if a name repeats.

    Renaming by position first keeps ``text`` usable beside ``TEXT`` or a second
    ``text``. Catalyst still prunes the scan to the chosen columns.
    """
    names = df.columns
    missing = sorted(set(columns.values()) - set(names))
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_c{names.index(n)}").alias(a) for a, n in columns.items()])


def whole_row(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with its columns packed, by position, into one more column, and that column's name."""
    name = "row"
    while name in {c.lower() for c in df.columns}:
        name += "_"
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.withColumn(name, F.struct(*plain.columns)).toDF(*df.columns, name), name


def fold(id_col: Column, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; a null id falls into fold -1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % modulus, F.lit(-1))


def fold_of(doc_id: int | None, modulus: int) -> int:
    """Python twin of :func:`fold`."""
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes.

    Spark counts rows only (10,000 by default), which for texts is any number of bytes, held by the JVM
    and by the worker. The bound is a setting of the session; one that the user has set stays.
    """
    conf = df.sparkSession.conf
    if conf.get(ARROW_BYTES, None) is None:
        conf.set(ARROW_BYTES, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Like ``checkpoint()`` it survives lost executors and cuts lineage, but it is
    columnar and compressed, and later reads prune columns.
    """
    spark: SparkSession = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` as a written table with one more column that tells all its rows apart, and that column's name."""
    uid = "uid"
    while uid in {c.lower() for c in docs.columns}:
        uid += "_"
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))]).withColumn("_uid", F.monotonically_increasing_id())
    return written(plain, name).toDF(*docs.columns, uid), uid


def without(table: DataFrame, lost: DataFrame) -> DataFrame:
    """Rows of a :func:`numbered` table whose number is not in ``lost[uid]``, with the columns it had before.

    The numbers are written first, so their size is known when the join is planned: as long as they fit
    Spark's broadcast threshold, no row of the table is shuffled; beyond it the join shuffles both sides.
    """
    lost = written(lost, "lost-rows")
    n = len(table.columns) - 1
    plain = table.toDF(*[f"_c{i}" for i in range(n)], "uid")
    return plain.join(lost, "uid", "left_anti").select(*[f"_c{i}" for i in range(n)]).toDF(*table.columns[:n])


def bit_of(column: Column | str) -> Column:
    """Place of an id in a bitmap of hashed ids."""
    return F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS))


def id_bitmap(bits: DataFrame) -> bytes:
    """Bitmap of the places in ``bits[bit]``, built in one aggregation; 4 MB."""
    # The bitmap functions count positions from 1 within buckets of 32768 bits.
    parts = (bits.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits")).collect())
    bitmap = bytearray(BITMAP_BITS // 8)
    for p in parts:
        at = (p["bucket"] - 1) * 4096
        bitmap[at:at + 4096] = p["bits"]
    return bytes(bitmap)


def bitmap_bits(bitmap: bytes) -> np.ndarray:
    """The bitmap as truth values by place."""
    return np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)


def groups(texts: list[str | None], limit: int) -> Iterator[tuple[int, int]]:
    """(start, length) of consecutive groups of about ``limit`` characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= limit:
            yield start, i + 1 - start
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts) - start


def sections(data: bytes, limit: int = SECTION_BYTES) -> Iterator[bytes]:
    """Cut ``data`` at ASCII white space into parts of about ``limit`` bytes.

    No word is ever cut: a single longer word stays whole.
    """
    start, n = 0, len(data)
    while n - start > limit:
        cut = start + limit
        found = max(data.rfind(c, start, cut) for c in (b" ", b"\n", b"\t", b"\r"))
        if found <= start:
            ahead = [p for c in (b" ", b"\n", b"\t", b"\r") if (p := data.find(c, cut)) >= 0]
            if not ahead:
                break
            found = min(ahead)
        yield data[start:found]
        start = found
    yield data[start:]
