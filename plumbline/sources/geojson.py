"""GeoJSON output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import geometry as g


# Features of the largest page.
MAX_PAGE = 500


def features(boundaries: DataFrame, properties: list[str], rings: str = "rings", name: str = "feature") -> DataFrame:
    """The boundaries with one GeoJSON Feature text each; a missing shape gives a null geometry."""
    props = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    shape = F.coalesce(F.expr(g.geojson(rings)), F.lit("null"))
    text = F.concat(F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'), props, F.lit("}"))
    return boundaries.withColumn(name, F.when(F.col(rings).isNull(), F.concat(
        F.lit('{"type":"Feature","geometry":null,"properties":'), props, F.lit("}"))).otherwise(text))


def write_features(boundaries: DataFrame, path: str, properties: list[str], rings: str = "rings") -> None:
    """One Feature per line."""
    features(boundaries, properties, rings).select("feature").write.mode("overwrite").text(path)


def collection(page: DataFrame, order: list[str], name: str = "feature") -> DataFrame:
    """One FeatureCollection text from one page of features, in the given order.

    A page is what `serving.page` gives; more than MAX_PAGE rows are an error.
    """
    # One row beyond the limit is enough to tell; so many are gathered at most.
    rows = page.orderBy(*order).limit(MAX_PAGE + 1)
    each = F.array_sort(F.collect_list(F.struct(*order, F.col(name).alias("_feature"))))
    joined = F.array_join(F.transform(each, lambda f: f["_feature"]), ",")
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}"))
    many = F.raise_error(F.lit(f"a page holds at most {MAX_PAGE} features")).cast("string")
    return rows.agg(F.when(F.count("*") > MAX_PAGE, many).otherwise(text).alias("collection"))
