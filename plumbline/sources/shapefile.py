"""Shapefiles: one `.shp` and `.dbf` pair per task, decoded into rings and attributes.

The format has no usable split points, so a pair is the unit of work; its size
is limited to 2 GB by the format itself. Records leave in small batches.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.sources.lake import replace_table

_BATCH = 1_000
# Shape type codes with polygon parts, and those of points.
_POLYGONS, _POINTS = {5, 15, 25}, {1, 11, 21}


def read_records(shp: bytes) -> Iterator[list | None]:
    """Rings (lists of x, y arrays) of each record; a point is one ring of one vertex."""
    at = 100
    while at + 8 <= len(shp):
        words = struct.unpack_from(">i", shp, at + 4)[0]
        kind = struct.unpack_from("<i", shp, at + 8)[0] if words >= 2 else 0
        if kind in _POLYGONS:
            n_parts, n_points = struct.unpack_from("<2i", shp, at + 44)
            starts = [*struct.unpack_from(f"<{n_parts}i", shp, at + 52), n_points]
            xy = np.frombuffer(shp, "<f8", 2 * n_points, at + 52 + 4 * n_parts).reshape(-1, 2)
            # The format turns shells clockwise; rings here run the other way.
            yield [xy[a:b][::-1] for a, b in zip(starts, starts[1:])]
        elif kind in _POINTS:
            yield [np.array([struct.unpack_from("<2d", shp, at + 12)])]
        else:
            yield None
        at += 8 + 2 * words


def read_attributes(dbf: bytes) -> Iterator[dict[str, str] | None]:
    """Attribute texts of each record, trimmed, empty ones as None; None for a deleted record."""
    count, header, width = struct.unpack_from("<IHH", dbf, 4)
    fields, at = [], 32
    while dbf[at] != 0x0D:
        name = dbf[at : at + 11].split(b"\0")[0].decode("ascii")
        fields.append((name, dbf[at + 16]))
        at += 32
    for i in range(count):
        row = dbf[header + i * width : header + (i + 1) * width]
        if row[:1] == b"*":
            yield None
            continue
        out, pos = {}, 1
        for name, length in fields:
            out[name] = row[pos : pos + length].decode("utf-8", "replace").strip() or None
            pos += length
        yield out


def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of `(stem, shp, dbf)` rows; files of few records share a batch, as one for each costs more than its records."""
    batch = []
    for frame in frames:
        for stem, shapes, table in frame[["stem", "shp", "dbf"]].itertuples(index=False):
            attributes = read_attributes(bytes(table)) if table is not None else iter(())
            for record, rings in enumerate(read_records(bytes(shapes))):
                values = next(attributes, {}) if table is not None else {}
                if values is None:
                    continue
                shape = None if rings is None else [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
                batch.append((stem, record, list(values.items()), shape))
                if len(batch) == _BATCH:
                    yield pd.DataFrame(batch, columns=["stem", "record", "attributes", "rings"])
                    batch = []
    if batch:
        yield pd.DataFrame(batch, columns=["stem", "record", "attributes", "rings"])


def decode_files(files: DataFrame) -> DataFrame:
    """`(stem, record, attributes, rings)` from `(path, content)` rows of `.shp` and `.dbf` files."""
    named = files.select(
        F.regexp_replace("path", r"\.[A-Za-z]+$", "").alias("stem"),
        F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)).alias("kind"),
        "content",
    )
    shp = named.filter("kind = 'shp'").select("stem", F.col("content").alias("shp"))
    dbf = named.filter("kind = 'dbf'").select("stem", F.col("content").alias("dbf"))

    schema = f"stem string, record int, attributes array<struct<key string, value string>>, rings {g.RINGS}"
    out = shp.join(dbf, "stem", "left").select("stem", "shp", "dbf").mapInPandas(decode, schema)
    return out.withColumn("attributes", F.map_from_entries("attributes"))


def read_shapefiles(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """All shapefiles under a path or glob; `fields` become text columns in place of the map."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.filter(F.lower("path").rlike(r"\.(shp|dbf)$")).select("path", "content")
    out = decode_files(files)
    if fields is None:
        return out
    return out.select("stem", "record", *[F.col("attributes")[f].alias(f.lower()) for f in fields], "rings")


def load_shapefiles(spark: SparkSession, path: str, table: str, fields: list[str] | None = None) -> None:
    """Replace the table at path `table` with every shapefile, one partition per file name."""
    df = read_shapefiles(spark, path, fields)
    replace_table(df.withColumn("source", F.substring_index("stem", "/", -1)), table, ["source"])
