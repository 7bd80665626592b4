"""Reflectance, quality masks, band names and indices as columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrocell.functions.hooks import CLEAR_TESTS, CORRECTIONS, by_sensor, clear_test, correction

BANDS = ["blue", "green", "red", "nir", "swir1", "swir2"]

#: The constellation of each span of years (fixed values): first year, last year, sensors.
CONSTELLATION = [(1900, 1998, ["LT05"]), (1999, 2012, ["LT05", "LE07"]), (2013, 2021, ["LE07", "LC08"]), (2022, 9999, ["LC08", "LC09"])]

#: Source bands by sensor family, in the order of BANDS (fixed values).
SOURCE_BANDS = {
    "LT05": ["SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B7"],
    "LE07": ["SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B7"],
    "LC08": ["SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B6", "SR_B7"],
    "LC09": ["SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B6", "SR_B7"],
    "S2": ["B2", "B3", "B4", "B8", "B11", "B12"],
}

#: Endmembers by band, reflectance times 10000 (fixed values).
ENDMEMBERS = {
    "gv": [119.0, 475.0, 169.0, 6250.0, 2399.0, 675.0],
    "npv": [1514.0, 1597.0, 1421.0, 3053.0, 7707.0, 1975.0],
    "soil": [1799.0, 2479.0, 3158.0, 5437.0, 7707.0, 6646.0],
    "cloud": [4031.0, 8714.0, 7900.0, 8989.0, 7002.0, 6607.0],
}


def reflectance(dn: Column) -> Column:
    return dn * 0.0000275 - 0.2


def temperature(dn: Column) -> Column:
    return dn * 0.00341802 + 149.0


@correction("LC08", "LC09")
def rectified(r: Column) -> Column:
    """Dark-target correction of the newer sensors: 55 ten-thousandths less, in whole ten-thousandths."""
    return F.round(r * 10000.0 - 55.0) / 10000.0


def corrected(sensor: Column, r: Column) -> Column:
    """Reflectance with its sensor's correction, if it has one."""
    return by_sensor(CORRECTIONS, sensor, r, lambda x: x)


def bit(v: Column, k: int) -> Column:
    return v.bitwiseAND(F.lit(1 << k)) != 0


def bits(v: Column, low: int, high: int) -> Column:
    """Bits low..high, both included, as a number."""
    return F.shiftright(v, low).bitwiseAND(F.lit((1 << (high - low + 1)) - 1))


@clear_test("LT05", "LE07")
def clear_old(qa: Column) -> Column:
    """Neither cloud (bit 3) nor shadow (bit 5)."""
    return ~bit(qa, 3) & ~bit(qa, 5)


def clear_new(qa: Column) -> Column:
    """Not ((bit 3 and bit 9) or bit 4)."""
    return ~((bit(qa, 3) & bit(qa, 9)) | bit(qa, 4))


def clear_or_water(qa: Column) -> Column:
    return bit(qa, 6) | bit(qa, 7)


def unsaturated(radsat: Column) -> Column:
    """None of the first seven bands is saturated."""
    return bits(radsat, 0, 6) == 0


def positive(*bands: Column) -> Column:
    out = F.lit(True)
    for b in bands:
        out = out & (b > 0)
    return out


def valid(sensor: Column, qa: Column, radsat: Column) -> Column:
    """The quality test of an observation by its sensor."""
    return by_sensor(CLEAR_TESTS, sensor, qa, clear_new) & clear_or_water(qa) & unsaturated(radsat)


def low_cloud(probability: Column, b8a: Column, b9: Column, most: float = 65) -> Column:
    """Cloud probability below ``most`` and both edge bands there."""
    return b8a.isNotNull() & b9.isNotNull() & (probability < most)


def scene_class_clear(scl: Column, strict: bool = False) -> Column:
    """Not saturated, shadow or cloud; ``strict`` also leaves out water and cirrus."""
    return ~scl.isin(*([1, 3, 6, 8, 9, 10] if strict else [1, 3, 8, 9]))


def strictly_clear(scl: Column, qa60: Column) -> Column:
    return scene_class_clear(scl, strict=True) & (qa60 < 1)


def cloud_score_clear(cs: Column, least: float = 0.40) -> Column:
    return cs >= least


def harmonised(df: DataFrame, sensor: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and the six bands under their common names."""
    return df.select(*keep, *[F.col(s).alias(b) for s, b in zip(SOURCE_BANDS[sensor], BANDS, strict=True)])


def nbr(nir: Column, swir2: Column) -> Column:
    """Normalised burn ratio; void where the bands sum to 0."""
    return F.try_divide(nir - swir2, nir + swir2)


def burn_index(nir: Column, swir2: Column) -> Column:
    """(1 - NBR) in whole thousandths, cut towards 0: larger is more burned."""
    return ((1.0 - nbr(nir, swir2)) * 1000.0).cast("int")


def severity_index(nir: Column, swir2: Column) -> Column:
    """-(NBR + 1) in whole thousandths, cut towards 0."""
    return (-(nbr(nir, swir2) + 1.0) * 1000.0).cast("int")


def unmixed(df: DataFrame, bands: list[str] = BANDS, endmembers: dict[str, list[float]] = ENDMEMBERS) -> DataFrame:
    """Least-squares fractions of the endmembers in whole percent, not below 0, with shade, gvs and npvSoil.

    The pseudo-inverse is one small matrix; each fraction is a linear column. npvSoil adds gv, soil and cloud.
    """
    inverse = np.linalg.pinv(np.array(list(endmembers.values())).T)
    out = df
    for name, row in zip(endmembers, inverse, strict=True):
        total = sum((F.col(b) * 10000.0 * float(w) for b, w in zip(bands[1:], row[1:], strict=True)), F.col(bands[0]) * 10000.0 * float(row[0]))
        out = out.withColumn(name, F.floor(F.least(F.greatest(total, F.lit(0.0)) * 100.0, F.lit(255.0))).cast("int"))
    total = F.col("gv") + F.col("npv") + F.col("soil") + F.col("cloud")
    return out.withColumns({"shade": F.abs(total - 100), "gvs": F.try_divide(F.col("gv") * 100.0, total), "npvSoil": F.col("gv") + F.col("soil") + F.col("cloud")})


def edge_distance_m(lon: Column, lat: Column, ring: Column) -> Column:
    """Metres from a point to the nearest edge of a ring of (lon, lat), on the local plane."""
    km = 111_320.0
    n = F.size(ring)
    px, py = lon * km * F.cos(F.radians(lat)), lat * km

    def distance(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i % n + 1)
        ax, ay, bx, by = (c * km * (F.cos(F.radians(lat)) if k % 2 == 0 else 1.0) for k, c in enumerate((a["lon"], a["lat"], b["lon"], b["lat"])))
        dx, dy = bx - ax, by - ay
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0))))
        return F.hypot(px - (ax + t * dx), py - (ay + t * dy))

    return F.array_min(F.transform(F.sequence(F.lit(1), n), distance))


def inside_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point lies in a ring of (lon, lat): an odd number of edges is crossed going east."""
    n = F.size(ring)

    def crossed(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i % n + 1)
        at = a["lon"] + F.try_divide((lat - a["lat"]) * (b["lon"] - a["lon"]), b["lat"] - a["lat"])
        return ((a["lat"] > lat) != (b["lat"] > lat)) & F.coalesce(lon < at, F.lit(False))

    return F.when(n > 0, F.size(F.filter(F.sequence(F.lit(1), n), crossed)) % 2 == 1).otherwise(False)


def metres_to_degrees(metres: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees of longitude and latitude that so many metres are at a latitude."""
    return metres / (111_320.0 * F.cos(F.radians(lat))), metres / 111_320.0


EARTH_RADIUS_M = 6_371_007.2


def cell_area_m2(lat: Column, d_lon: float, d_lat: float) -> Column:
    """The area on a sphere of the cell with this centre latitude and size in degrees."""
    return F.lit(EARTH_RADIUS_M**2) * F.radians(F.lit(d_lon)) * (F.sin(F.radians(lat + d_lat / 2)) - F.sin(F.radians(lat - d_lat / 2)))
