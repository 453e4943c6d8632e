"""Tag rules (F3, G8–G14) and user identifiers.

A tag rule is a function of columns returning a Column of ``array<string>``;
:data:`TAG_FAMILIES` is the registry, so a new family is one entry.  Every
tag weighs 1.0 in its record, and a tag repeated inside one record counts
once (the reference merges them into a map).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five identifier columns, in priority order (the first
# non-blank one is the record's main id).
ID_COLUMNS = ("imei", "mac", "idfa", "openudid", "androidid")

# Tag prefixes.
APP, CLIENT, OPERATOR, NETWORK, DEVICE_TYPE, DEVICE = "APP_", "CB_", "ISP_", "NM_", "DT_", "DEVICE_"
PROVINCE, CITY, AD_TYPE, CHANNEL, AGE, SEX, KEYWORD, AREA = (
    "PN_", "CTN_", "AT_", "CN_", "AGE_", "SEX_", "KW_", "BA_")


def _text(col: Column) -> Column:
    # String interpolation of a NULL reads "null".
    return F.coalesce(col.cast("string"), F.lit("null"))


def _has_text(col: Column) -> Column:
    """Whether a text holds more than the white space of ``\\s``."""
    return F.btrim(col, F.lit(" \t\n\x0b\f\r")) != ""


def _tag(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), _text(col))


def java_split(col: Column, sep: str = ",") -> Column:
    """``split`` with Java's rule: trailing empty pieces are dropped.

    ``'a,,b,,'`` → ``[a, '', b]``; ``''`` → ``['']``; ``',,'`` → ``[]``.
    """
    stripped = F.regexp_replace(col, sep + "+$", "")
    return (F.when(col == "", F.array(F.lit("")))
            .when(~F.endswith(col, F.lit(sep)), F.split(col, sep))  # nothing to strip: no regular expression
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, sep)))


def app_tags(appname: Column, dict_name: Column) -> Column:
    """The dictionary is consulted only when ``appname`` is NULL; a miss reads 'null'."""
    return F.array(_tag(APP, F.coalesce(appname, dict_name)))


def device_tags(client_code: Column, operator_code: Column, network_code: Column,
                devicetype: Column, device: Column) -> Column:
    """Codes come from the device dictionary; NULL ``devicetype`` reads 0."""
    return F.array(_tag(CLIENT, client_code), _tag(OPERATOR, operator_code),
                   _tag(NETWORK, network_code),
                   F.concat(F.lit(DEVICE_TYPE), F.coalesce(devicetype, F.lit(0)).cast("string")),
                   _tag(DEVICE, device))


def region_tags(province: Column, city: Column) -> Column:
    """G10."""
    return F.array(_tag(PROVINCE, province), _tag(CITY, city))


def simple_tag(prefix: str, col: Column) -> Column:
    """Ad type, channel, age, sex — prefix + raw value."""
    return F.array(_tag(prefix, col))


def keyword_tags(keywords: Column) -> Column:
    """One tag per comma piece (Java split); NULL keywords give no tag."""
    return F.when(keywords.isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(java_split(keywords), lambda k: F.concat(F.lit(KEYWORD), k)))


def area_tags(areas: Column) -> Column:
    """One tag per comma piece when ``areas`` is not blank."""
    return F.when(F.coalesce(_has_text(areas), F.lit(False)),
                  F.transform(java_split(areas), lambda a: F.concat(F.lit(AREA), a))
                  ).otherwise(F.array().cast("array<string>"))


# family name → rule over the enriched record columns
TAG_FAMILIES: dict[str, Callable[[], Column]] = {
    "app": lambda: app_tags(F.col("appname"), F.col("app_dict_name")),
    "device": lambda: device_tags(F.col("client_code"), F.col("operator_code"),
                                  F.col("network_code"), F.col("devicetype"), F.col("device")),
    "region": lambda: region_tags(F.col("province"), F.col("city")),
    "adtype": lambda: simple_tag(AD_TYPE, F.col("adspacetypename")),
    "keyword": lambda: keyword_tags(F.col("keywords")),
    "channel": lambda: simple_tag(CHANNEL, F.col("channelid")),
    "age": lambda: simple_tag(AGE, F.col("age")),
    "sex": lambda: simple_tag(SEX, F.col("sex")),
    "area": lambda: area_tags(F.col("areas")),
}


def record_tags(families=None) -> Column:
    """The union of the families' tags, each tag once per record."""
    names = list(families) if families is not None else list(TAG_FAMILIES)
    return F.array_distinct(F.concat(*[TAG_FAMILIES[n]() for n in names]))


def any_identifier() -> Column:
    """At least one identifier is neither NULL nor ''."""
    cond = None
    for c in ID_COLUMNS:
        one = F.col(c).isNotNull() & (F.col(c) != "")
        cond = one if cond is None else cond | one
    return cond


def user_ids() -> Column:
    """Non-blank identifiers in priority order (values are not trimmed)."""
    return F.filter(F.array(*[F.col(c) for c in ID_COLUMNS]), lambda x: x.isNotNull() & _has_text(x))


def any_user_id() -> Column:
    """Whether :func:`user_ids` holds an identifier."""
    return F.coalesce(F.exists(F.array(*[F.col(c) for c in ID_COLUMNS]), _has_text), F.lit(False))


def main_id(ids: Column) -> Column:
    """The first identifier."""
    return F.element_at(ids, 1)
