"""What several corpus operators need: shared intermediate tables, Arrow text access, null-safe joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts of the operators define it.
SPACES = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that the driver and all executors see.

    It is the checkpoint folder the cluster names in ``spark.checkpoint.dir``.
    Only a local session without one gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="corpus-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` as a table in the shared folder and read it back.

    Later steps start from the files, so a lost executor costs no recomputation
    of what came before.
    """
    spark = rows.sparkSession
    path = new_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def forget(rows: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        if folder.startswith(shared_folder(spark)):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator on documents that keeps their columns, whatever they are called.

    Operators name their own columns ``__...``; a user's column of such a name bears another one meanwhile.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        odd = {c: f"user column {i}" for i, c in enumerate(docs.columns) if c.startswith("__")}
        if not odd:
            return operator(docs, *args, **options)
        return operator(docs.withColumnsRenamed(odd), *args, **options).withColumnsRenamed({v: k for k, v in odd.items()})

    return run


def ordered_by(rows: DataFrame, *columns: str) -> Column:
    """A struct that orders rows by the given columns, maps by their JSON."""
    plain = lambda name: "map<" not in rows.schema[name].dataType.simpleString()
    return F.struct(*[F.col(c) if plain(c) else F.to_json(F.struct(c)).alias(c) for c in columns])


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Join condition on equal columns, NULL equal to NULL."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; NULL counts as empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has about ``most`` bytes of text, one row at least."""
    _, offsets = buffer(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last
