"""Session SQL functions for geometry, inlined by Catalyst where they are called."""

from __future__ import annotations

from pyspark.sql import SparkSession

from plumbline.functions import geometry as g
from plumbline.functions import projection as p

# name -> (parameters, return type, body)
SQL_FUNCTIONS = {
    "st_point": ("px DOUBLE, py DOUBLE", g.POINT, g.point("px", "py")),
    "st_geomfromwkt": ("wkt STRING", g.RINGS, g.rings_from_wkt("wkt")),
    "st_pointfromwkt": ("wkt STRING", g.POINT, g.point_from_wkt("wkt")),
    "st_geometrytype": ("wkt STRING", "STRING", g.geometry_type("wkt")),
    "st_contains": (f"rings {g.RINGS}, pt {g.POINT}", "BOOLEAN", g.contains("rings", "pt.x", "pt.y")),
    "st_intersects": (f"a {g.RINGS}, b {g.RINGS}", "BOOLEAN", g.intersects("a", "b")),
    "st_area": (f"rings {g.RINGS}", "DOUBLE", g.area("rings")),
    "st_perimeter": (f"rings {g.RINGS}", "DOUBLE", g.perimeter("rings")),
    "st_distance": (f"rings {g.RINGS}, pt {g.POINT}", "DOUBLE", g.distance("rings", "pt.x", "pt.y")),
    "st_pointonsurface": (f"rings {g.RINGS}", g.POINT, g.point_on_surface("rings")),
    "st_asgeojson": (f"rings {g.RINGS}", "STRING", g.geojson("rings")),
    "st_polsbypopper": (f"rings {g.RINGS}", "DOUBLE", g.polsby_popper("rings")),
    "st_to5070": (f"pt {g.POINT}", g.POINT, p.albers("pt.x", "pt.y")),
    "st_to3968": (f"pt {g.POINT}", g.POINT, p.lambert("pt.x", "pt.y")),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create every geometry function in the session; returns their names."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
