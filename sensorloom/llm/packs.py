"""Documents packed into pieces of bounded size, in a table bucketed by piece.

Several passes over the same texts join small per-piece rows to this table; the texts themselves are never shuffled.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import pieces, text_bytes

PIECES = "piece long, ids binary, known binary, sizes binary, packed binary"


def _pack(batches, most):
    """Documents -> pieces of whole documents, in the order of the scan."""
    task, n, packer = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
    for whole in batches:
        for batch in pieces(whole, "text", most):
            data, off = text_bytes(batch.column("text"))
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array([(task << 32) + n], pa.int64()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([known.tobytes()], pa.binary()),
                pa.array([np.diff(off).astype(np.int64).tobytes()], pa.binary()), pa.array([packer.compress(data.tobytes())], pa.binary()),
            ], names=[c.split()[0] for c in PIECES.split(", ")])
            n += 1


def unpacked(batches):
    """Each piece as (ids, known, offsets, bytes, row of the batch)."""
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        for r in range(batch.num_rows):
            get = lambda c: batch.column(c)[r].as_py()  # noqa: B023, E731
            sizes = np.frombuffer(get("sizes"), np.int64)
            off = np.r_[0, np.cumsum(sizes)]
            data = np.frombuffer(opener.decompress(get("packed"), max_output_size=max(1, int(off[-1]))), np.uint8) if off[-1] else np.zeros(0, np.uint8)
            yield get, np.frombuffer(get("ids"), np.int64), np.frombuffer(get("known"), bool), off, data


def pack(docs: DataFrame, most: int) -> tuple[DataFrame, str]:
    """The bucketed table of (doc_id, text) in pieces of about ``most`` bytes, and its name, to drop it by."""
    spark = docs.sparkSession
    n = max(docs.select("doc_id").rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"pieces_{uuid.uuid4().hex[:12]}"
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = thin.mapInArrow(lambda it: _pack(it, most), PIECES)
    made.write.format("parquet").option("compression", "none").bucketBy(n, "piece").saveAsTable(name)
    return spark.table(name), name
