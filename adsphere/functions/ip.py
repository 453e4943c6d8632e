"""IPv4 and location-text expressions (G1–G6), all plain Catalyst columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the IP database for a failed lookup, the LAN area
# marker and its display text, and the province separator.
UNKNOWN_COUNTRY = "未知国家"
UNKNOWN_AREA = "未知地区"
LAN_AREA = "CZ88.NET"
LAN_AREA_LABEL = "本机或本网络"
PROVINCE_MARK = "省"

_IPV4 = r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$"


def ip_to_number(ip: Column) -> Column:
    """G1: dotted IPv4 text → bigint; malformed text (or an octet > 255) → NULL."""
    # cut by dots rather than split into an array, which each of the eight uses would build again
    upto = [F.substring_index(ip, ".", i) for i in range(1, 4)]
    parts = [upto[0], *[F.substring_index(p, ".", -1) for p in (upto[1], upto[2], ip)]]
    octets = [p.try_cast("bigint") for p in parts]
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    valid = ip.rlike(_IPV4)
    for o in octets:
        valid = valid & (o <= 255)
    return F.when(valid, value)


def number_to_ip(n: Column) -> Column:
    """Bigint → dotted text."""
    return F.concat_ws(".", *[(F.shiftright(n, s) % 256).cast("string") for s in (24, 16, 8, 0)])


def _trimmed(country: Column) -> Column:
    # Java's split drops trailing empty pieces: strip trailing marks first.
    return F.regexp_replace(F.coalesce(country, F.lit("")), PROVINCE_MARK + "+$", "")


def province_of(country: Column) -> Column:
    """Text before the first mark plus the mark when something follows it, else the text."""
    t = _trimmed(country)
    return F.when(t.contains(PROVINCE_MARK),
                  F.concat(F.element_at(F.split(t, PROVINCE_MARK), 1), F.lit(PROVINCE_MARK))
                  ).otherwise(F.coalesce(country, F.lit("")))


def city_of(country: Column) -> Column:
    """Second piece of the split on the mark, else the whole text."""
    t = _trimmed(country)
    return F.when(t.contains(PROVINCE_MARK), F.element_at(F.split(t, PROVINCE_MARK), 2)
                  ).otherwise(F.coalesce(country, F.lit("")))


def area_label(area: Column) -> Column:
    """The LAN marker (surrounding blanks ignored) is shown as the local-network label."""
    return F.when(F.trim(area) == LAN_AREA, F.lit(LAN_AREA_LABEL)).otherwise(area)
