"""Geohash encoding and the zone grid as pure Column expressions (no UDF).

A precision-p geohash interleaves ceil(5p/2) longitude bits with floor(5p/2)
latitude bits, longitude first, and spells the result in base 32.  Each
coordinate's bit string is the index of its cell on a regular 2^b grid, so we
quantise with floor() and interleave with the usual bit-spreading (Morton)
masks; everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonefare.config import GEOHASH_ALPHABET, PricingConfig

# bit-spreading masks for 16-bit inputs: abcd -> 0a0b0c0d
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread_bits(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = F.shiftleft(x, shift).bitwiseOR(x).bitwiseAND(F.lit(mask))
    return x


def _cell(value: Column, lo: float, span: float, bits: int) -> Column:
    cell = F.floor((value - F.lit(lo)) / F.lit(span) * F.lit(float(1 << bits))).cast("long")
    return F.least(cell, F.lit((1 << bits) - 1))  # the upper edge belongs to the last cell


def geohash(lat: Column | str, lon: Column | str, precision: int = 6) -> Column:
    """Base-32 geohash of (lat, lon); precision 6 (30 bits) is the zone cell."""
    if precision > 6:
        raise ValueError("precision up to 6 (30 bits) is supported")
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    nbits = 5 * precision
    lon_bits = (nbits + 1) // 2
    lat_bits = nbits // 2
    lon_cell = _cell(lon, -180.0, 360.0, lon_bits)
    lat_cell = _cell(lat, -90.0, 180.0, lat_bits)
    if lon_bits == lat_bits:
        code = F.shiftleft(_spread_bits(lon_cell), 1).bitwiseOR(_spread_bits(lat_cell))
    else:  # odd bit count: longitude carries the extra low bit
        code = _spread_bits(lon_cell).bitwiseOR(F.shiftleft(_spread_bits(lat_cell), 1))
    chars = []
    for c in range(precision):
        idx = F.shiftright(code, 5 * (precision - 1 - c)).bitwiseAND(F.lit(31)).cast("int")
        chars.append(F.substr(F.lit(GEOHASH_ALPHABET), idx + 1, F.lit(1)))
    return F.concat(*chars)


def with_geohash(df, lat: str, lon: str, out: str, precision: int = 6):
    """DataFrame form of geohash(): each bit-spreading step is its own
    column, so the expression tree stays linear in size (the Column form
    repeats sub-expressions and is meant for a handful of rows)."""
    if precision > 6:
        raise ValueError("precision up to 6 (30 bits) is supported")
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    df = (df.withColumn("_gx", _cell(F.col(lon), -180.0, 360.0, lon_bits))
          .withColumn("_gy", _cell(F.col(lat), -90.0, 180.0, lat_bits)))
    for shift, mask in _SPREAD:
        df = (df.withColumn("_gx", F.shiftleft("_gx", shift).bitwiseOR(F.col("_gx")).bitwiseAND(F.lit(mask)))
              .withColumn("_gy", F.shiftleft("_gy", shift).bitwiseOR(F.col("_gy")).bitwiseAND(F.lit(mask))))
    if lon_bits == lat_bits:
        code = F.shiftleft("_gx", 1).bitwiseOR(F.col("_gy"))
    else:
        code = F.col("_gx").bitwiseOR(F.shiftleft("_gy", 1))
    df = df.withColumn("_gc", code)
    chars = [F.substr(F.lit(GEOHASH_ALPHABET),
                      F.shiftright("_gc", 5 * (precision - 1 - c)).bitwiseAND(F.lit(31)).cast("int") + 1,
                      F.lit(1)) for c in range(precision)]
    return df.withColumn(out, F.concat(*chars)).drop("_gx", "_gy", "_gc")


def zone_grid_columns(zone_idx: Column, cfg: PricingConfig) -> dict[str, Column]:
    """City, grid offsets and centre of global zone number `zone_idx`.

    Zones are numbered city by city in config order; inside a city the grid
    is walked row-major over i, j in [-side, side) with side = int(sqrt(n))+1,
    stepping 0.01 degree, and the first n cells are the city's zones.
    """
    city = lat0 = lon0 = local = side = None
    start = 0
    for c in cfg.cities:
        s = int(c.num_zones ** 0.5) + 1
        cond = zone_idx < F.lit(start + c.num_zones)
        pick = (lambda acc, v, cond=cond: F.when(cond, v) if acc is None else acc.when(cond, v))
        city = pick(city, F.lit(c.name))
        lat0 = pick(lat0, F.lit(float(c.latitude)))
        lon0 = pick(lon0, F.lit(float(c.longitude)))
        local = pick(local, zone_idx - F.lit(start))
        side = pick(side, F.lit(s))
        start += c.num_zones
    width = side * 2
    grid_i = (F.floor(local / width) - side).cast("int")
    grid_j = (local - F.floor(local / width) * width - side).cast("int")
    latitude = lat0 + grid_i.cast("double") * F.lit(0.01)
    longitude = lon0 + grid_j.cast("double") * F.lit(0.01)
    return {
        "city": city,
        "grid_i": grid_i,
        "grid_j": grid_j,
        "latitude": latitude,
        "longitude": longitude,
    }
