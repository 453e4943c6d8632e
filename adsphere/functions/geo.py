"""Geohash and geocoder-response expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The geohash base-32 alphabet (public geohash standard).
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"



def _cell(v: Column, lo: float, span: float, bits: int) -> Column:
    idx = F.floor((v.cast("double") - F.lit(lo)) / F.lit(span) * F.lit(float(1 << bits)))
    # least and greatest skip NULLs, so a missing coordinate has to be kept missing
    return F.when(idx.isNotNull(), F.least(F.greatest(idx, F.lit(0).cast("bigint")),
                                           F.lit((1 << bits) - 1).cast("bigint")))


def geohash(latitude: Column, longitude: Column, precision: int = 8) -> Column:
    """Base-32 geohash, bits interleaved starting from longitude.

    Pure arithmetic — codegen'd, no UDF.  Cell index = floor of the scaled
    coordinate, clamped so lon 180 / lat 90 fall in the last cell; inputs
    are widened to double (a float column keeps its float value).  Each
    output character reads its five bits straight from the two cell indices,
    so the expression stays linear in the precision.
    """
    total = 5 * precision
    lon_bits = (total + 1) // 2
    lat_bits = total // 2
    x = _cell(longitude, -180.0, 360.0, lon_bits)
    y = _cell(latitude, -90.0, 180.0, lat_bits)

    def bit(t: int) -> Column:
        # t-th interleaved bit from the top: even → longitude, odd → latitude
        if t % 2 == 0:
            return F.shiftright(x, lon_bits - 1 - t // 2).bitwiseAND(F.lit(1))
        return F.shiftright(y, lat_bits - 1 - t // 2).bitwiseAND(F.lit(1))

    alphabet = F.lit(GEOHASH_ALPHABET)
    chars = []
    for k in range(precision):
        idx = None
        for m in range(5):
            term = F.shiftleft(bit(5 * k + m), 4 - m)
            idx = term if idx is None else idx.bitwiseOR(term)
        chars.append(alphabet.substr(idx.cast("int") + 1, F.lit(1)))
    return F.concat(*chars)


def geohash8(latitude: Column, longitude: Column) -> Column:
    return geohash(latitude, longitude, 8)


def location_text(longitude: Column, latitude: Column) -> Column:
    """``"lon,lat"`` text as sent to a geocoder."""
    return F.concat_ws(",", longitude.cast("string"), latitude.cast("string"))


AREA_ITEM = T.StructType([T.StructField("location", T.StringType()),
                          T.StructField("name", T.StringType()),
                          T.StructField("id", T.StringType())])
GEOCODE_RESPONSE = T.StructType([T.StructField("regeocode", T.StructType([
    T.StructField("addressComponent", T.StructType([
        T.StructField("businessAreas", T.ArrayType(AREA_ITEM))]))]))])


def area_names(response: Column) -> Column:
    """Area names in response order; NULL when the text does not parse."""
    parsed = F.from_json(response, GEOCODE_RESPONSE, {"mode": "PERMISSIVE"})
    return parsed["regeocode"]["addressComponent"]["businessAreas"]["name"]


def areas_text(response: Column) -> Column:
    """Names joined by ','; any failure (bad JSON, ``[[]]``) gives ''."""
    return F.coalesce(F.concat_ws(",", area_names(response)), F.lit(""))
