"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or frames Spark derives from them) in
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql
from .functions import sql as _sql
from .functions.codec import decode_pairs as _decode
from .functions.codec import encode_pairs as _encode
from .functions.geo import geohash8 as _geohash8
from .functions.tags import ID_COLUMNS as _IDC
from .functions.tags import any_identifier as _p3
from .functions.tags import main_id as _main_id
from .functions.tags import user_ids as _user_ids
from .operators import incremental as _inc
from .operators import sketch as _sketch
from .operators import skew as _sk
from .operators import tag_agg as _ta
from .operators.components import connected_components as _cc
from .operators.components import graph_summary as _graph_summary
from .plans import business_area as _ba
from .plans import feed as _feed
from .plans import ods as _ods
from .plans import profile as _pf
from .plans import reports
from .plans import tagging as _tg
from .session import materialize as _materialize
from .sources import keyed as _keyed
from .sources import layout as _layout
from .sources import range_file as _rf
from .sources import snapshots as _snap
from .sources.adlog import AD_LOG_EXPRESSIONS as _LOG_SQL
from .sources.adlog import AD_LOG_COLUMNS as _FIXTURE_COLUMNS
from .sources.adlog import HISTORY_DS as _HDS
from .sources.adlog import TODAY_DS as _TDS
from .sources.adlog import FUNNEL_INPUT as _FUNNEL
from .sources.adlog import ad_log as _ad_log
from .sources.dictionary import read_kv_dictionary as _read_kv
from .sources.dims import app_dictionary as _app_dict
from .sources.dims import geocode_responses as _geocode
from .sources.dims import ip_ranges as _ip_ranges
from .sources.jsonlog import AD_LOG_FIELDS as _LOG_FIELDS
from .sources.jsonlog import read_json_lines as _read_lines
from .sources.tables import read_table as _read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _report(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.report_from_log(spark, sf_dir, name)
    run.__name__ = name
    return run


for _name in ("report_province_city", "report_region", "report_app", "report_device",
              "report_network", "report_operator", "report_channel"):
    register(_name)(_report(_name))


def _ods_report(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A1/A2 on the ODS: province and city come from the IP join."""
        columns = [] if name == "report_province_city" else list(_FUNNEL)
        return reports.report(_ods.build_ods(spark, sf_dir, [*columns, "province", "city"]), name)
    run.__name__ = f"ods_{name}"
    return run


for _name in ("report_province_city", "report_region"):
    register(f"ods_{_name}")(_ods_report(_name))


# ---------------------------------------------------------------- the raw log

#: The fields of the JSON log derived from lineitem alone, and the rules that spoil some of its lines.
_LINE_FIELDS = ("requestmode", "client", "adorderid", "appid", "ispname", "winprice")


def _json_lines(spark, sf_dir):
    """A JSON log: each row a line; some cut short, some no object, some with a wrong type, some with a field too many."""
    li = _read(spark, sf_dir, "lineitem").select(
        *[F.expr(_LOG_SQL[c]).alias(c) for c in _LINE_FIELDS], F.col("l_orderkey").alias("_o"), F.col("l_linenumber").alias("_l"))
    fields = [F.col(c) for c in _LINE_FIELDS]
    plain = F.to_json(F.struct(*fields))
    extra = F.to_json(F.struct(*fields, F.struct(F.col("_l").alias("number")).alias("extra")))
    wrong = F.to_json(F.struct(*[F.lit("many").alias(c) if c == "client" else F.col(c) for c in _LINE_FIELDS]))
    line = (F.when(F.col("_o") % 41 == 0, F.expr("left(p, length(p) - 1)")).when(F.col("_o") % 43 == 0, F.concat(F.lit("["), "p", F.lit("]")))
            .when(F.col("_o") % 47 == 0, F.col("w")).when(F.col("_o") % 53 == 0, F.col("e")).otherwise(F.col("p")))
    return li.select("_o", plain.alias("p"), extra.alias("e"), wrong.alias("w")).select(line.alias("value"))


@register("log_quarantine")
def log_quarantine(spark, sf_dir):
    """The JSON log written as text and read with rescue; what each kind of line became."""
    path = f"{_tg.warehouse(spark)}/log"
    _json_lines(spark, sf_dir).write.text(path)
    lines = _read_lines(spark, path)
    kind = (F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("rescued").isNotNull(), "rescued").otherwise("record"))
    number = F.try_variant_get("rescued", "$.extra.number", "bigint")
    return lines.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count("adorderid").alias("n_orders"), F.sum("client").alias("client_sum"),
        F.sum(number).alias("extra_sum"), F.count_if(F.try_variant_get("rescued", "$.client", "string") == "many").alias("n_wrong"))


# ---------------------------------------------------------------- IP enrichment


@register("ip_distinct")
def ip_distinct(spark, sf_dir):
    return _ods.distinct_ips(_ad_log(spark, sf_dir, ["ip"]))


@register("ip_geo")
def ip_geo(spark, sf_dir):
    ips = _ods.distinct_ips(_ad_log(spark, sf_dir, ["ip"]))
    return _ods.lookup_ips(ips, _ip_ranges(spark, sf_dir))


@register("ip_file_geo")
def ip_file_geo(spark, sf_dir):
    """The ranges written as a binary range file, read back, and looked up."""
    path = f"{_tg.warehouse(spark)}/ranges.dat"
    ranges = _rf.file_ranges(spark, _rf.write_range_file(spark, _ip_ranges(spark, sf_dir), path))
    ips = _ods.distinct_ips(_ad_log(spark, sf_dir, ["ip"]))
    return _ods.lookup_ips(ips, _materialize(ranges, "file-ranges")).drop("longitude", "latitude")


@register("ip_text")
def ip_text(spark, sf_dir):
    """G1, G2 as SQL functions: address text to number and back."""
    _sql.register_functions(spark)
    return spark.sql("SELECT ip, ip_number(ip) AS ip_num, ip_text(ip_number(ip)) AS ip_text FROM {ips}",
                     ips=_ods.distinct_ips(_ad_log(spark, sf_dir, ["ip"])))


@register("region_city_split")
def region_city_split(spark, sf_dir):
    ods = _ods.build_ods(spark, sf_dir, ["ip", "province", "city"])
    return ods.groupBy("province", "city").agg(F.count(F.lit(1)).alias("n_rows"))


def _full_ods(spark, sf_dir):
    """All 89 columns; coordinates, province and city come from the IP join."""
    columns = [n for n, _ in _LOG_FIELDS if n in _FIXTURE_COLUMNS]
    ods = _ods.full_ods(_ad_log(spark, sf_dir, columns), _ip_ranges(spark, sf_dir))
    return _as_double(ods)


@register("ods_build")
def ods_build(spark, sf_dir):
    return _full_ods(spark, sf_dir)


# ---------------------------------------------------------------- business areas


_COORDS = ["longitude", "latitude"]


def _as_double(df):
    return df.withColumn("latitude", F.col("latitude").cast("double")).withColumn(
        "longitude", F.col("longitude").cast("double"))


def _coord_areas(spark, sf_dir):
    coords = _ba.distinct_coordinates(_ad_log(spark, sf_dir, _COORDS))
    return _ba.coordinate_areas(coords, _geocode(spark, sf_dir))


@register("coords_distinct")
def coords_distinct(spark, sf_dir):
    return _as_double(_ba.distinct_coordinates(_ad_log(spark, sf_dir, _COORDS)))


@register("geohash8")
def geohash8_query(spark, sf_dir):
    coords = _ba.has_coordinates(_ad_log(spark, sf_dir, _COORDS)).select("latitude", "longitude").distinct()
    return _as_double(coords.withColumn("geohash", _geohash8(F.col("latitude"), F.col("longitude"))))


@register("sql_geohash")
def sql_geohash(spark, sf_dir):
    """the geohash as a function that SQL calls."""
    _sql.register_functions(spark)
    return spark.sql("SELECT DISTINCT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
                     "geohash8(latitude, longitude) AS geohash FROM {log} WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
                     log=_ad_log(spark, sf_dir, _COORDS))


@register("area_json")
def area_json(spark, sf_dir):
    return _as_double(_coord_areas(spark, sf_dir).select("latitude", "longitude", "areas"))


@register("area_library")
def area_library(spark, sf_dir):
    return _ba.area_library(_coord_areas(spark, sf_dir))


def _stored_library(spark, sf_dir):
    return _materialize(_ba.area_library(_coord_areas(spark, sf_dir)), "area-library")


@register("ods_with_areas")
def ods_with_areas(spark, sf_dir):
    ods = _ad_log(spark, sf_dir, ["ip", "mac", "androidid", "requestmode", *_COORDS])
    lib = _stored_library(spark, sf_dir)
    return _ba.with_areas(ods, lib).select("ip", "mac", "androidid", "requestmode", "geohash", "areas")


@register("area_lookup")
def area_lookup(spark, sf_dir):
    cells = (_ba.has_coordinates(_ad_log(spark, sf_dir, _COORDS))
             .select(_geohash8(F.col("latitude"), F.col("longitude")).alias("geohash")).distinct())
    return _ba.lookup_areas(cells, _stored_library(spark, sf_dir))


@register("area_point")
def area_point(spark, sf_dir):
    """One geohash, the greatest, looked up in sorted files."""
    path = _layout.write_sorted(_stored_library(spark, sf_dir), f"{_tg.warehouse(spark)}/areas", "geohash")
    last = spark.read.parquet(path).agg(F.max("geohash").alias("g")).first()["g"]
    return _layout.point_lookup(spark, path, "geohash", F.lit(last))


# ---------------------------------------------------------------- tags and identity


def _id_records(spark, sf_dir):
    recs = (_ad_log(spark, sf_dir, list(_IDC)).where(_p3()).select(_user_ids().alias("ids"))
            .where(F.size("ids") > 0).withColumn("main_id", _main_id(F.col("ids"))))
    return recs


def _all_components(recs):
    comps = _cc(_ta.identity_edges(recs))
    nodes = recs.select(F.explode("ids").alias("id")).distinct()
    return (nodes.join(comps, "id", "left")
            .select("id", F.coalesce(F.col("component"), F.col("id")).alias("component")))


@register("identified_rows")
def identified_rows(spark, sf_dir):
    return _ad_log(spark, sf_dir, list(_IDC)).where(_p3())


@register("identity_ids")
def identity_ids(spark, sf_dir):
    recs = _id_records(spark, sf_dir)
    return recs.select("main_id", F.array_join("ids", ",").alias("ids"), F.size("ids").cast("bigint").alias("n_ids"))


@register("identity_edges")
def identity_edges(spark, sf_dir):
    return _ta.identity_edges(_id_records(spark, sf_dir))


@register("identity_components")
def identity_components(spark, sf_dir):
    return _all_components(_materialize(_id_records(spark, sf_dir), "id-records"))


@register("graph_size")
def graph_size(spark, sf_dir):
    return _graph_summary(_ta.identity_edges(_id_records(spark, sf_dir)))


@register("identity_records")
def identity_records(spark, sf_dir):
    recs = _materialize(_id_records(spark, sf_dir), "id-records")
    comps = _cc(_ta.identity_edges(recs))
    # count per main id first: a hot main id reaches the join as one row
    per_main = recs.groupBy("main_id").agg(F.count(F.lit(1)).alias("n_records"))
    return _ta.assign_person(per_main, comps).select("person", "main_id", "n_records")


JOIN_BUCKETS = 16


@register("bucketed_person_join")
def bucketed_person_join(spark, sf_dir):
    """The ODS and the persons as bucketed tables; every record with its person, without a shuffle."""
    log = _ad_log(spark, sf_dir, ["ip", "requestmode", *_IDC]).where(_p3())
    log = log.select("ip", "requestmode", _user_ids().alias("ids")).where(F.size("ids") > 0)
    log = _materialize(log.select(_main_id(F.col("ids")).alias("id"), "ids", "ip", "requestmode"), "log-ids")
    comps = _all_components(log.select("ids", F.col("id").alias("main_id")))
    left, right = _layout.salted_pair(log.drop("ids"), _materialize(comps, "persons"), "id", ["ip", "requestmode"])
    root = _tg.warehouse(spark)
    name = "t" + root.rsplit("-", 1)[1]
    for side, df in (("log", left), ("persons", right)):
        _layout.write_bucketed(df, f"{name}_{side}", f"{root}/{side}", ["id", _sk.SALT], JOIN_BUCKETS)
    return _layout.bucketed_join(spark, f"{name}_log", f"{name}_persons", "id")


@register("component_members")
def component_members(spark, sf_dir):
    return _ta.component_members(_all_components(_materialize(_id_records(spark, sf_dir), "id-records")))


@register("tag_record")
def tag_record(spark, sf_dir):
    return _ta.tags_per_main_record(_tg.records_for(spark, sf_dir))


def _family_vocabulary(families):
    def run(spark, sf_dir):
        recs = _tg.records_for(spark, sf_dir, families)
        return recs.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return run


for _name, _fams in {"tag_app": ["app"], "tag_device": ["device"], "tag_region": ["region"],
                     "tag_simple": ["adtype", "channel", "age", "sex"], "tag_keyword": ["keyword"],
                     "tag_area": ["area"]}.items():
    register(_name)(_family_vocabulary(_fams))


@register("tag_agg")
def tag_agg(spark, sf_dir):
    tags, _ = _tg.today_profile(spark, sf_dir)
    return _ta.as_doubles(tags)


@register("history_tags")
def history_tags(spark, sf_dir):
    tags, _ = _tg.history_profile(spark, sf_dir)
    return _ta.as_doubles(tags)


@register("tag_decay")
def tag_decay(spark, sf_dir):
    tags, _ = _tg.history_profile(spark, sf_dir)
    return _ta.as_doubles(_ta.decay(tags))


@register("tag_merge")
def tag_merge(spark, sf_dir):
    tags, _ = _tg.merged_profile(spark, sf_dir)
    return _ta.as_doubles(tags)


@register("day_touched")
def day_touched(spark, sf_dir):
    """The persons that today's records touched, and those that became part of another."""
    return _inc.touched(_tg.two_days(spark, sf_dir), _TDS)


@register("dict_file_lookup")
def dict_file_lookup(spark, sf_dir):
    """The app dictionary as a ``key##value`` file, read back and looked up."""
    path = f"{_tg.warehouse(spark)}/apps"
    _app_dict(spark, sf_dir).select(F.concat_ws("##", "appid", "name").alias("value")).write.text(path)
    apps = _ad_log(spark, sf_dir, ["appid"]).select("appid").distinct()
    return _tg.lookup(apps, F.col("appid"), _read_kv(spark, path), "name")


@register("dict_lookup")
def dict_lookup(spark, sf_dir):
    apps = _ad_log(spark, sf_dir, ["appid"]).select("appid").distinct()
    return _tg.lookup(apps, F.col("appid"), _app_dict(spark, sf_dir), "name")


# ---------------------------------------------------------------- profile export and snapshots


def _merged(spark, sf_dir):
    tags, _ = _tg.merged_profile(spark, sf_dir)
    return _ta.as_doubles(tags)


def _texts(spark, sf_dir):
    # one row per person: the text form is a person's row in the interchange format
    return _merged(spark, sf_dir).groupBy("person").agg(
        _encode(F.collect_list(F.struct("tag", "weight"))).alias("tags"),
        F.count(F.lit(1)).alias("n_tags"))


@register("tag_codec")
def tag_codec(spark, sf_dir):
    return _texts(spark, sf_dir)


@register("tag_decode")
def tag_decode(spark, sf_dir):
    """G15 then G16: the encoded texts, stored, read back and decoded."""
    stored = _materialize(_texts(spark, sf_dir), "tag-texts")
    return stored.select("person", F.explode(_decode(F.col("tags"))).alias("p")).select("person", "p.tag", "p.weight")


@register("profile_classify")
def profile_classify(spark, sf_dir):
    return _pf.classify_tags(_merged(spark, sf_dir)).where(F.col("field").isNotNull())


@register("profile_docs")
def profile_docs(spark, sf_dir):
    return _pf.document_texts(_pf.profile_rows(_pf.classify_tags(_merged(spark, sf_dir))))


def _plain_documents(tags):
    """(_id, doc) with the 14 fields' texts as one."""
    rows = _pf.document_texts(_pf.profile_rows(_pf.classify_tags(_ta.as_doubles(tags))))
    return rows.select("_id", F.concat_ws("|", *_pf.PROFILE_FIELDS).alias("doc"))


@register("document_feed")
def document_feed(spark, sf_dir):
    """What leads from yesterday's documents to today's."""
    store = _tg.two_days(spark, sf_dir)
    before, after = (_materialize(_plain_documents(_inc.persons(store, ds)[0]), "documents") for ds in (_HDS, _TDS))
    return _feed.change_feed(before, after)


@register("day_suffixes")
def day_suffixes(spark, sf_dir):
    """The log's days as suffixes, with the day before."""
    day = F.to_date("l_shipdate")
    return (_read(spark, sf_dir, "lineitem").groupBy(_snap.day_suffix(day).alias("ds"), _snap.previous_day_suffix(day).alias("before"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("keyed_insert")
def keyed_insert(spark, sf_dir):
    """Two batches inserted under a key; what went in and what was rejected, why and how often."""
    root, key = _tg.warehouse(spark), F.when(F.col("o_custkey") % 17 != 0, F.col("o_custkey"))
    orders = _read(spark, sf_dir, "orders").select(key.alias("custkey"), F.col("o_orderstatus").alias("status"), "o_orderkey")
    out = None
    for batch in (0, 1):
        rows = orders.where(F.col("o_orderkey") % 2 == batch).drop("o_orderkey")
        accepted, rejected = _keyed.insert_keyed(rows, root, "CUSTOMER_STATUS", _TDS, ["custkey"])
        part = (accepted.withColumns({"reason": F.lit("accepted"), "n": F.lit(1).cast("bigint")}).unionByName(rejected)
                .withColumn("batch", F.lit(batch)))
        out = part if out is None else out.unionByName(part)
    return out


@register("snapshot_read")
def snapshot_read(spark, sf_dir):
    """Both days written as ``ds`` partitions, today's read back."""
    root = _tg.warehouse(spark)
    for ds in (_HDS, _TDS):
        ods = _ods.build_ods(spark, sf_dir, ["ip", "appid", "requestmode"], ds=ds)
        ods = _ods.enrich(ods, _ip_ranges(spark, sf_dir).drop("longitude", "latitude")).select(*_SNAP_COLUMNS)
        _snap.write_snapshot(ods, root, "ODS", ds)
    return _snap.read_snapshot(spark, root, "ODS", _TDS, ods.schema).withColumn("ds", F.lit(_TDS))


_SNAP_COLUMNS = ["ip", "appid", "requestmode", "province", "city"]


@register("sink_key_check")
def sink_key_check(spark, sf_dir):
    return _snap.duplicate_keys(_ods.build_ods(spark, sf_dir, ["ip"]), ["ip"])


# ---------------------------------------------------------------- skew toolkit

HOT_SHARE = 0.001  # a customer with this share of all orders is a hot key: at most 1,000 of them
SALT_BUCKETS = 10


def _orders(spark, sf_dir):
    return _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")


def _customers(spark, sf_dir):
    return _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")


@register("skew_hot_keys")
def skew_hot_keys(spark, sf_dir):
    return _sk.hot_keys(_orders(spark, sf_dir), "o_custkey", min_share=HOT_SHARE)


@register("skew_hot_keys_sketched")
def skew_hot_keys_sketched(spark, sf_dir):
    """A13 from one stored sketch per month, merged; candidates counted exactly."""
    orders = _read(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("month"))
    sketches = _materialize(_sketch.day_sketches(orders, "o_custkey", "month", HOT_SHARE), "key-sketches")
    return _sketch.hot_keys_from_sketches(orders, sketches, "o_custkey", HOT_SHARE)


@register("partition_rows")
def partition_rows(spark, sf_dir):
    """The rows of the partitions that the salted keys fall into, as salted and as counted."""
    salted = _orders(spark, sf_dir).withColumn("salt", _sk.salt(["o_orderkey"], SALT_BUCKETS)).repartition(SALT_BUCKETS, "salt")
    return _sk.rows_per_partition(salted).agg(F.sum("n").alias("n_rows"))


@register("skew_filter_join")
def skew_filter_join(spark, sf_dir):
    recs = _materialize(_id_records(spark, sf_dir), "id-records")
    comps = _all_components(recs)
    log = _ad_log(spark, sf_dir, ["androidid", "mac"])
    out = _sk.filter_null_keys_join(log, comps, "androidid", "id", preserve=True)
    return out.select("androidid", "mac", "component")


@register("skew_broadcast_join")
def skew_broadcast_join(spark, sf_dir):
    return _sk.broadcast_join(_orders(spark, sf_dir), _customers(spark, sf_dir), "o_custkey")


@register("skew_two_phase_count")
def skew_two_phase_count(spark, sf_dir):
    return _sk.two_phase_count(_orders(spark, sf_dir), "o_custkey", ["o_orderkey"], SALT_BUCKETS)


@register("sql_salted_count")
def sql_salted_count(spark, sf_dir):
    """The two-phase count as SQL text with salt and unsalt."""
    _sql.register_functions(spark)
    return spark.sql(
        "SELECT CAST(unsalt(k) AS BIGINT) AS o_custkey, sum(n) AS n FROM ("
        "SELECT salt(o_orderkey, {buckets}, CAST(o_custkey AS STRING)) AS k, count(*) AS n FROM {orders} GROUP BY 1) GROUP BY 1",
        orders=_orders(spark, sf_dir), buckets=SALT_BUCKETS)


@register("skew_isolate_join")
def skew_isolate_join(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    hot = _materialize(_sk.hot_keys(orders, "o_custkey", min_share=HOT_SHARE), "hot-keys")
    # max_rows=0: run the salted join itself, whatever the size of the right side
    return _sk.isolate_hot_keys_join(orders, _customers(spark, sf_dir), "o_custkey", hot,
                                     ["o_orderkey"], SALT_BUCKETS, max_rows=0)


@register("skew_expand_join")
def skew_expand_join(spark, sf_dir):
    return _sk.expand_join(_orders(spark, sf_dir), _customers(spark, sf_dir), "o_custkey",
                           ["o_orderkey"], SALT_BUCKETS, max_rows=0)


def oracle() -> dict[str, str]:
    sql = oracle_sql.all_queries()
    return {k: v for k, v in sql.items() if k in QUERIES}
