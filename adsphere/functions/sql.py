"""The library's scalar functions as SQL functions (F1, F2).

They are defined in SQL, so Catalyst puts their bodies into the calling query: no Python, no UDF call,
and predicates on their results can be pushed and folded like any expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .geo import GEOHASH_ALPHABET


def geohash_body(latitude: str, longitude: str, precision: int = 8) -> str:
    """The SQL text of a geohash: the two cell numbers, five interleaved bits a character."""
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2

    def cell(v: str, low: float, span: float, bits: int) -> str:
        n = f"floor((CAST({v} AS DOUBLE) - ({low}D)) / {span}D * {float(1 << bits)}D)"
        return f"least(greatest({n}, 0L), {(1 << bits) - 1}L)"

    # x: longitude's cell, y: latitude's
    def bit(t: int) -> str:
        return (f"(shiftright(c.x, {lon_bits - 1 - t // 2}) & 1)" if t % 2 == 0
                else f"(shiftright(c.y, {lat_bits - 1 - t // 2}) & 1)")

    chars = [f"substr('{GEOHASH_ALPHABET}', CAST({' + '.join(f'{1 << 4 - m} * {bit(5 * k + m)}' for m in range(5))} AS INT) + 1, 1)"
             for k in range(precision)]
    cells = f"named_struct('x', {cell(longitude, -180.0, 360.0, lon_bits)}, 'y', {cell(latitude, -90.0, 180.0, lat_bits)})"
    # one lambda binds both cells, so that each is written and computed once
    return (f"CASE WHEN {latitude} IS NOT NULL AND {longitude} IS NOT NULL THEN "
            f"transform(array({cells}), c -> concat({', '.join(chars)}))[0] END")


#: name → (parameters, result, body).
FUNCTIONS = {
    "geohash8": ("latitude DOUBLE, longitude DOUBLE", "STRING", geohash_body("latitude", "longitude")),
    # a salt is made of the row, never drawn: a task that runs again salts alike
    "salt": ("row BIGINT, buckets INT, key STRING", "STRING", "concat(CAST(pmod(xxhash64(row), buckets) AS STRING), '@', key)"),
    "unsalt": ("salted STRING", "STRING", "substr(salted, instr(salted, '@') + 1)"),
    "ip_number": ("ip STRING", "BIGINT",
                  r"CASE WHEN ip RLIKE '^[0-9]{1,3}([.][0-9]{1,3}){3}$' AND forall(split(ip, '[.]'), o -> CAST(o AS INT) <= 255) "
                  r"THEN aggregate(split(ip, '[.]'), 0L, (a, o) -> a * 256 + CAST(o AS BIGINT)) END"),
    "ip_text": ("number BIGINT", "STRING",
                "CASE WHEN number IS NOT NULL THEN "
                "concat_ws('.', transform(array(24, 16, 8, 0), s -> CAST(shiftright(number, s) & 255 AS STRING))) END"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to ``spark.sql`` for this session."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return sorted(FUNCTIONS)
