"""GEOID, address and code strings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# GEOID length of each level that can be a parent.
PARENT_LENGTHS = {"state": 2, "county": 5, "tract": 11}

# Parent level of each summary level.
PARENT_LEVELS = {
    "county": "state",
    "tract": "county",
    "block_group": "tract",
    "place": "state",
    "cd": "state",
    "vtd": "county",
    "sldu": "state",
    "sldl": "state",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_blank(c) -> Column:
    """Null for the empty string."""
    return F.nullif(_col(c), F.lit(""))


def geoids_from_fips(state, county, tract, block) -> dict[str, Column]:
    """GEOIDs built from FIPS parts; a missing part leaves the finer levels null.

    The block group is the tract plus the first digit of the block, or the
    tract alone when the block is unknown.
    """
    state, county, tract, block = (non_blank(c) for c in (state, county, tract, block))
    county_geoid = F.concat(state, county)
    tract_geoid = F.concat(county_geoid, tract)
    return {
        "state_geoid": state,
        "county_geoid": county_geoid,
        "tract_geoid": tract_geoid,
        "block_group_geoid": F.concat(tract_geoid, F.coalesce(F.substring(block, 1, 1), F.lit(""))),
        "block_geoid": F.concat(tract_geoid, block),
    }


def parent_geoid(geoid, level) -> Column:
    """Enclosing GEOID for a summary level, null for a state or a short code."""
    geoid, level = _col(geoid), _col(level)
    out = F.lit(None).cast("string")
    for child, parent in PARENT_LEVELS.items():
        n = PARENT_LENGTHS[parent]
        out = F.when((level == child) & (F.length(geoid) >= n), F.substring(geoid, 1, n)).otherwise(out)
    return out


def last_pipe_part(c) -> Column:
    return F.substring_index(_col(c), "|", -1)


def zero_pad(c, width: int) -> Column:
    """Pad on the left, never cutting a longer value."""
    c = _col(c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def street_line(number, name, suffix) -> Column:
    return F.concat_ws(" ", *[non_blank(c) for c in (number, name, suffix)])


def one_line_address(number, name, suffix, city, state, zip5) -> Column:
    parts = [non_blank(street_line(number, name, suffix)), *[non_blank(c) for c in (city, state, zip5)]]
    return F.concat_ws(", ", *parts)


def split_address(address) -> Column:
    """Comma address as struct(street, city, state, zip, city_state_zip, raw).

    Three or more parts give street, city, state and zip; two give street and
    the rest; anything else stays raw.
    """
    address = _col(address)
    parts = F.transform(F.split(address, ","), lambda p: F.trim(p))
    n = F.size(parts)
    tail = F.split(F.trim(F.get(parts, F.lit(2))), r"\s+")
    null = F.lit(None).cast("string")
    return F.struct(
        F.when(n >= 2, F.get(parts, F.lit(0))).otherwise(null).alias("street"),
        F.when(n >= 3, F.get(parts, F.lit(1))).otherwise(null).alias("city"),
        F.when(n >= 3, non_blank(F.get(tail, F.lit(0)))).otherwise(null).alias("state"),
        F.when(n >= 3, non_blank(F.get(tail, F.lit(1)))).otherwise(null).alias("zip"),
        F.when(n == 2, F.get(parts, F.lit(1))).otherwise(null).alias("city_state_zip"),
        F.when(n < 2, address).otherwise(null).alias("raw"),
    )


def is_estimate(code) -> Column:
    return _col(code).endswith("E")


def is_moe(code) -> Column:
    return _col(code).endswith("M")


def moe_code(code) -> Column:
    """Margin-of-error code that belongs to an estimate code."""
    return F.regexp_replace(_col(code), "E$", "M")
