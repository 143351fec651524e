"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from groundmill.sources.scratch import cut, discard, fresh_path, mark, release, shared_dir

__all__ = ["cut", "discard", "documents", "fresh_path", "map_column", "mark", "parallelism", "release", "shared_dir"]


def map_column(df: DataFrame, column: str, name: str, kind: str, make: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``df`` with ``name``, of the SQL type ``kind``, made from ``column`` some MB at a time; no other column changes.

    A column already called ``name`` is replaced and stands last.
    """
    schema = StructType([f for f in df.schema.fields if f.name != name] + [StructField(name, DataType.fromDDL(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [i for i, n in enumerate(batch.schema.names) if n != name]
            source = batch.column(batch.schema.get_field_index(column))
            step = max(1, min(1024, int(len(batch) * (16 << 20) / max(1, source.nbytes))))
            for i in range(0, len(batch), step):
                part = batch.slice(i, step)
                yield pa.RecordBatch.from_arrays([part.column(j) for j in keep] + [make(source.slice(i, step))], [batch.schema.names[j] for j in keep] + [name])

    return df.mapInArrow(run, schema)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
