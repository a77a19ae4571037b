"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# Rows handed to Python at once; with whole texts in them, more would only cost memory.
BATCH_ROWS = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(schema: str) -> pa.Schema:
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    return to_arrow_schema(parsed)


# What tasks of one stage share in a Python worker, under the number of that stage.
_kept: dict[int, dict] = {}


def stage_cache() -> dict:
    """What earlier tasks of this stage left in this worker; what another stage left is dropped."""
    context = TaskContext.get()
    stage = context.stageId() if context else -1
    if stage not in _kept:
        _kept.clear()
    return _kept.setdefault(stage, {})


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Runs Python over batches of columns, as dictionaries of lists.

    `make` is called once in each task and returns the function of a batch, so
    models live as long as the task, and what `stage_cache` holds as long as the
    worker runs tasks of the stage. Batches hold BATCH_ROWS rows.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        stage_cache()
        for batch in batches:
            fn = fn or make()
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                columns = fn({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)
