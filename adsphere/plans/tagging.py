"""The tagging job: ODS + business areas + dictionaries → tagged records → persons.

Mirrors the reference job's stages (filter, area join, dictionary lookups,
nine tag families, identity graph, aggregation, history merge) as one
DataFrame plan.  The fact tables are joined once: the ODS is written, and
both the area library and the records are made from it.  A record's areas
come from the library of its own day.  Only the lookups that the wanted
families read are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import ID_COLUMNS, TAG_FAMILIES, any_identifier, any_user_id, main_id, record_tags, user_ids
from ..operators.incremental import add_day, persons
from ..operators.joins import checked_broadcast
from ..operators.tag_agg import DEFAULT_DECAY, merge_history, merge_in_one_pass, person_profile
from ..session import materialize, scratch_path, scratch_scope
from ..sources.adlog import HISTORY_DS, TODAY_DS
from ..sources.dims import (CLIENT_OTHER, DEVICE_DICTIONARY, NETWORK_OTHER, OPERATOR_OTHER, app_dictionary,
                            geocode_responses)
from ..sources.person_store import PersonStore
from ..sources.snapshots import read_snapshot, write_snapshot
from . import business_area as ba
from .ods import build_ods

# ODS columns each tag family reads (besides the identifiers).
FAMILY_INPUT = {
    "app": ("appid", "appname"), "device": ("client", "ispname", "networkmannername", "devicetype", "device"),
    "region": ("ip", "province", "city"), "adtype": ("adspacetypename",), "keyword": ("keywords",),
    "channel": ("channelid",), "age": ("age",), "sex": ("sex",), "area": ("longitude", "latitude"),
}
TAG_SCHEMA = "person string, tag string, weight decimal(28,18)"
ID_SCHEMA = "person string, id string"


def lookup(df: DataFrame, key: DataFrame | object, dictionary: DataFrame, out: str, default=None) -> DataFrame:
    """Left join to a (key, value) dictionary, broadcast after a size check."""
    joined = df.join(checked_broadcast(dictionary.toDF("_k", out)), key == F.col("_k"), "left").drop("_k")
    if default is not None:
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return joined


def device_code(value: Column, default: str) -> Column:
    """J5 against the fixed device dictionary: its 13 entries as one expression, no join."""
    code = None
    for k, v in DEVICE_DICTIONARY:
        code = F.when(value == k, v) if code is None else code.when(value == k, v)
    return code.otherwise(default)


def identified(ods: DataFrame) -> DataFrame:
    """P3."""
    return ods.where(any_identifier())


def attach(ods: DataFrame, families=None, library: DataFrame | None = None, apps: DataFrame | None = None,
           devices: DataFrame | None = None, by: tuple = ()) -> DataFrame:
    """Identified ODS rows with what the families read: areas, app names, device codes.

    ``library`` and ``apps`` are needed by the families ``area`` and ``app``;
    ``devices`` replaces the fixed device dictionary.
    """
    families = list(families if families is not None else TAG_FAMILIES)
    df = identified(ods)
    if "area" in families:
        df = ba.with_areas(df, library, by)
    if "app" in families:
        df = lookup(df, F.col("appid"), apps, "app_dict_name")
    if "device" in families:
        # a NULL client reads 0 (unboxed long), which the dictionary does not hold
        wanted = (("client_code", F.coalesce(F.col("client"), F.lit(0)).cast("string"), CLIENT_OTHER),
                  ("operator_code", F.col("ispname"), OPERATOR_OTHER),
                  ("network_code", F.col("networkmannername"), NETWORK_OTHER))
        for out, key, default in wanted:
            df = (df.withColumn(out, device_code(key, default)) if devices is None
                  else lookup(df, key, devices, out, default))
    return df


def tagged_records(inputs: DataFrame, families=None) -> DataFrame:
    """(ds, main_id, ids, tags) per identified record; blank-only ids dropped."""
    cols = ["ds"] if "ds" in inputs.columns else []
    recs = inputs.where(any_user_id()).select(*cols, user_ids().alias("ids"), record_tags(families).alias("tags"))
    return recs.withColumn("main_id", main_id(F.col("ids")))


def day(records: DataFrame, ds: str) -> DataFrame:
    return records.where(F.col("ds") == ds).drop("ds")


def records_for(spark: SparkSession, sf_dir: str, families=None, ds: str | None = None) -> DataFrame:
    """Tagged records of both fixture days (or of day ``ds`` only, read with the day
    predicate in the scan), written once as a table reused by every consumer."""
    names = list(families if families is not None else TAG_FAMILIES)
    columns = dict.fromkeys([c for f in names for c in FAMILY_INPUT[f]] + list(ID_COLUMNS))
    ods = build_ods(spark, sf_dir, list(columns), with_ds=True, ds=ds)
    library = None
    with scratch_scope(spark):  # the ODS and the library are needed for the records only
        if "area" in names:
            ods = materialize(ods, "tag-ods")
            coords = ba.distinct_coordinates(ods, ("ds",))
            library = materialize(ba.area_library(
                ba.coordinate_areas(coords, geocode_responses(spark, sf_dir), ("ds",)), ("ds",)), "area-library")
        apps = app_dictionary(spark, sf_dir) if "app" in names else None
        return materialize(tagged_records(attach(ods, names, library, apps, by=("ds",)), names), "tagged-records", outlives=True)


def two_days(spark: SparkSession, sf_dir: str, families=None) -> PersonStore:
    """Both fixture days added to a person store one after the other."""
    store = PersonStore(spark, warehouse(spark))
    with scratch_scope(spark):  # the store holds all that is needed of the records
        records = records_for(spark, sf_dir, families)
        for ds in (HISTORY_DS, TODAY_DS):
            add_day(store, day(records, ds), ds)
    return store


def today_profile(spark: SparkSession, sf_dir: str, families=None):
    return person_profile(day(records_for(spark, sf_dir, families, TODAY_DS), TODAY_DS))


def store_profile(tags: DataFrame, ids: DataFrame, root: str, ds: str) -> None:
    """One day's TAG and TAG_IDS snapshots."""
    write_snapshot(tags.select("person", "tag", "weight"), root, "TAG", ds, keys=["person"])
    write_snapshot(ids.select("person", "id"), root, "TAG_IDS", ds, keys=["person"])


def stored_profile(spark: SparkSession, root: str, ds: str) -> tuple[DataFrame, DataFrame]:
    """S3: a day's TAG and TAG_IDS snapshots; empty frames where the day was not run."""
    return (read_snapshot(spark, root, "TAG", ds, TAG_SCHEMA), read_snapshot(spark, root, "TAG_IDS", ds, ID_SCHEMA))


def warehouse(spark: SparkSession) -> str:
    """A folder of its own under the shared root, for the snapshots a query writes."""
    import uuid

    return scratch_path(spark, f"warehouse-{uuid.uuid4().hex}")


def history_profile(spark: SparkSession, sf_dir: str, families=None, root: str | None = None,
                    records: DataFrame | None = None):
    """S3: the history day run and stored, then read back from its snapshot."""
    root = root or warehouse(spark)
    if records is None:
        records = records_for(spark, sf_dir, families, HISTORY_DS)
    store_profile(*person_profile(day(records, HISTORY_DS)), root, HISTORY_DS)
    return stored_profile(spark, root, HISTORY_DS)


def merged_profile(spark: SparkSession, sf_dir: str, families=None, coefficient: float = DEFAULT_DECAY):
    """E8 as the daily job runs it: both days added to the stored persons one after the other, today's
    edges contracted onto yesterday's persons, and the persons read as of today."""
    return persons(two_days(spark, sf_dir, families), TODAY_DS, coefficient)


def merged_from_snapshots(spark: SparkSession, sf_dir: str, families=None, coefficient: float = DEFAULT_DECAY):
    """The same from full snapshots: components over all of yesterday's ids and today's edges (a property
    the tests hold the incremental merge against)."""
    root = warehouse(spark)
    records = records_for(spark, sf_dir, families)
    h_tags, h_ids = history_profile(spark, sf_dir, families, root, records)
    store_profile(*merge_history(h_tags, h_ids, day(records, TODAY_DS), coefficient), root, TODAY_DS)
    return stored_profile(spark, root, TODAY_DS)


def merged_in_one_pass(spark: SparkSession, sf_dir: str, families=None, coefficient: float = DEFAULT_DECAY):
    """The same for two days of raw records at once (a property the tests hold the staged merge against)."""
    return merge_in_one_pass(records_for(spark, sf_dir, families), TODAY_DS, coefficient)
