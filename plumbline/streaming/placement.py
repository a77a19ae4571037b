"""Points of a stream placed in static boundaries.

Cleaning, codes and point-in-polygon keep no state, so they run on a stream as they
do on a table: each micro-batch is joined with the same boundary index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.grid import cell_index
from plumbline.operators.pip import point_in_polygon
from plumbline.session import spool


def place_stream(points: DataFrame, boundaries: DataFrame, *, x: str = "x", y: str = "y", splits: int | None = None) -> DataFrame:
    """The stream's points with the boundaries that contain them (inner)."""
    index = spool(cell_index(boundaries, splits=splits), "index")
    return point_in_polygon(points, index, x=x, y=y)


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet folder, each input row once; stops when the available input is done."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
