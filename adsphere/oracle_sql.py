"""DuckDB oracle queries, one per ``queries()`` key.

Written independently of the Spark operators, in plain SQL over the
driver's views (``lineitem``, ``orders``, ``customer``, ``nation``,
``part``).  Only the *input* definition — the fixture's log columns and the
dimension rules of FIXTURES §3 — is shared text; every operator is
re-expressed here in SQL.
"""

from __future__ import annotations

from .sources.adlog import AD_LOG_EXPRESSIONS, DS_EXPRESSION, HISTORY_DS, TODAY_DS
from .sources.dims import RANGE_LATITUDE, RANGE_LONGITUDE
from .sources.jsonlog import AD_LOG_FIELDS


def ad_log_cte(name: str = "ad_log") -> str:
    cols = ",\n  ".join(f"{expr} AS {col}" for col, expr in AD_LOG_EXPRESSIONS.items())
    return (f"{name} AS (SELECT\n  {cols}\n FROM lineitem"
            " JOIN orders ON l_orderkey = o_orderkey"
            " JOIN customer ON o_custkey = c_custkey"
            " JOIN nation ON c_nationkey = n_nationkey"
            " JOIN part ON l_partkey = p_partkey)")


def ad_log_ds_cte(name: str = "ad_log_ds") -> str:
    return f"{name} AS (SELECT *, {DS_EXPRESSION} AS ds FROM ad_log)"


_A = "adplatformproviderid >= 100000"
_PAID = (f"{_A} AND iseffective = 1 AND isbilling = 1 AND iswin = 1 "
         "AND adorderid > 200000 AND adcreativeid > 200000")

FUNNEL_SELECT = f"""
  count(*) FILTER (WHERE requestmode = 1 AND processnode >= 1) AS org_num,
  count(*) FILTER (WHERE requestmode = 1 AND processnode >= 2) AS valid_num,
  count(*) FILTER (WHERE requestmode = 1 AND processnode = 3) AS ad_num,
  count(*) FILTER (WHERE {_A} AND iseffective = 1 AND isbilling = 1 AND isbid = 1 AND adorderid <> 0) AS bid_num,
  count(*) FILTER (WHERE iseffective = 1 AND iswin = 1 AND isbilling = 1 AND {_A}) AS bid_success_num,
  count(*) FILTER (WHERE requestmode = 2 AND iseffective = 1) AS show_num,
  count(*) FILTER (WHERE requestmode = 3 AND iseffective = 1) AS click_num,
  count(*) FILTER (WHERE requestmode = 2 AND iseffective = 1 AND isbilling = 1) AS media_show_num,
  count(*) FILTER (WHERE requestmode = 3 AND iseffective = 1 AND isbilling = 1) AS media_click_num,
  CAST(coalesce(sum(CASE WHEN {_PAID} THEN CAST(winprice AS DECIMAL(28,10)) END), 0) AS DOUBLE) / 1000.0 AS consumption_number,
  CAST(coalesce(sum(CASE WHEN {_PAID} THEN CAST(adpayment AS DECIMAL(28,10)) END), 0) AS DOUBLE) / 1000.0 AS cost_number"""

FUNNEL_OUTER = """org_num, valid_num, ad_num, bid_num, bid_success_num,
  bid_success_num / nullif(bid_num, 0) AS bid_success_rat, show_num, click_num,
  click_num / nullif(show_num, 0) AS click_rat, media_show_num, media_click_num,
  consumption_number, cost_number"""


def funnel_sql(dims: list[str], label_client: bool = False) -> str:
    d = ", ".join(dims)
    if label_client:
        outer_dims = ("CASE WHEN client = 1 THEN 'android ' WHEN client = 2 THEN 'ios' "
                      "WHEN client = 3 THEN 'wp' ELSE 'other' END AS client, client AS client_id, device")
    else:
        outer_dims = d
    return (f"WITH {ad_log_cte()},\n t AS (SELECT {d}, {FUNNEL_SELECT}\n FROM ad_log GROUP BY {d})\n"
            f"SELECT {outer_dims}, {FUNNEL_OUTER} FROM t")


def report_queries() -> dict[str, str]:
    return {
        "report_province_city": (f"WITH {ad_log_cte()} SELECT province, city, count(1) AS n "
                                 "FROM ad_log GROUP BY province, city"),
        "report_region": funnel_sql(["province", "city"]),
        "report_app": funnel_sql(["appid", "appname"]),
        "report_device": funnel_sql(["client", "device"], label_client=True),
        "report_network": funnel_sql(["networkmannerid", "networkmannername"]),
        "report_operator": funnel_sql(["ispname"]),
        "report_channel": funnel_sql(["channelid"]),
    }


# ---------------------------------------------------------------- IP enrichment
IP_RANGES_CTE = """ip_ranges AS (
 SELECT CAST(16 + n_nationkey AS BIGINT) * 16777216 + b.lo AS start_ip,
        CAST(16 + n_nationkey AS BIGINT) * 16777216 + b.hi AS end_ip,
        CASE WHEN b.j < 3 THEN 'P' || n_nationkey || '省C' || n_nationkey || '_' || b.j
             ELSE 'M' || n_nationkey END AS country,
        CASE WHEN b.j = 2 THEN ' CZ88.NET' ELSE 'ISP' || b.j END AS area,
        """ + RANGE_LONGITUDE + """ AS longitude, """ + RANGE_LATITUDE + """ AS latitude
 FROM (SELECT n_nationkey, unnest([{'j': 0, 'lo': 0, 'hi': 255}, {'j': 1, 'lo': 256, 'hi': 1023},
                                   {'j': 2, 'lo': 1100, 'hi': 4095}, {'j': 3, 'lo': 4096, 'hi': 16777215}]) AS b
       FROM nation WHERE n_nationkey <> 24) t)"""


def ip_num_sql(ip: str = "ip") -> str:
    octs = [f"TRY_CAST(split_part({ip}, '.', {i}) AS BIGINT)" for i in range(1, 5)]
    valid = " AND ".join([f"regexp_full_match({ip}, '[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}')"]
                         + [f"{o} <= 255" for o in octs])
    return (f"CASE WHEN {valid} THEN {octs[0]} * 16777216 + {octs[1]} * 65536 + "
            f"{octs[2]} * 256 + {octs[3]} END")


def province_sql(c: str) -> str:
    t = f"regexp_replace(coalesce({c}, ''), '省+$', '')"
    return f"CASE WHEN strpos({t}, '省') > 0 THEN substr({t}, 1, strpos({t}, '省')) ELSE coalesce({c}, '') END"


def city_sql(c: str) -> str:
    t = f"regexp_replace(coalesce({c}, ''), '省+$', '')"
    rest = f"substr({t}, strpos({t}, '省') + 1)"
    return (f"CASE WHEN strpos({t}, '省') > 0 THEN CASE WHEN strpos({rest}, '省') > 0 "
            f"THEN substr({rest}, 1, strpos({rest}, '省') - 1) ELSE {rest} END ELSE coalesce({c}, '') END")


def _ods_cte() -> str:
    cols = [c for c in AD_LOG_EXPRESSIONS if c not in ("province", "city", "ip")]
    country = "coalesce(r.country, '未知国家')"
    return (f"ods AS (SELECT l.ip, {', '.join('l.' + c for c in cols)},\n"
            f"  CASE WHEN l.ip IS NOT NULL AND l.ip <> '' THEN {province_sql(country)} END AS province,\n"
            f"  CASE WHEN l.ip IS NOT NULL AND l.ip <> '' THEN {city_sql(country)} END AS city\n"
            f" FROM ad_log l LEFT JOIN ip_ranges r ON {ip_num_sql('l.ip')} BETWEEN r.start_ip AND r.end_ip)")


_DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}


def _full_ods_cte() -> str:
    """All 85 log fields (NULL where the fixture has none) and the four location columns."""
    fields = ", ".join(f"l.{n}" if n in AD_LOG_EXPRESSIONS else f"CAST(NULL AS {_DUCK_TYPES[t.simpleString()]}) AS {n}"
                       for n, t in AD_LOG_FIELDS)
    country = "coalesce(r.country, '未知国家')"
    return (f"full_ods AS (SELECT {fields}, CAST(r.longitude AS DOUBLE) AS longitude, CAST(r.latitude AS DOUBLE) AS latitude,\n"
            f"  CASE WHEN l.ip IS NOT NULL AND l.ip <> '' THEN {province_sql(country)} END AS province,\n"
            f"  CASE WHEN l.ip IS NOT NULL AND l.ip <> '' THEN {city_sql(country)} END AS city\n"
            f" FROM ad_log l LEFT JOIN ip_ranges r ON {ip_num_sql('l.ip')} BETWEEN r.start_ip AND r.end_ip)")


def ip_queries() -> dict[str, str]:
    base = f"WITH {ad_log_cte()}, {IP_RANGES_CTE}"
    geo = (f"{base}, ips AS (SELECT DISTINCT ip FROM ad_log WHERE ip IS NOT NULL AND ip <> ''),\n"
           f" g AS (SELECT ip, {ip_num_sql('ip')} AS ip_num, coalesce(r.country, '未知国家') AS country,\n"
           f"   coalesce(CASE WHEN trim(r.area) = 'CZ88.NET' THEN '本机或本网络' ELSE r.area END, '未知地区') AS area,\n"
           "   CAST(r.longitude AS DOUBLE) AS longitude, CAST(r.latitude AS DOUBLE) AS latitude\n"
           f"  FROM ips LEFT JOIN ip_ranges r ON {ip_num_sql('ip')} BETWEEN r.start_ip AND r.end_ip)\n")
    return {
        "ip_distinct": f"WITH {ad_log_cte()} SELECT DISTINCT ip FROM ad_log WHERE ip IS NOT NULL AND ip <> ''",
        "ip_geo": geo + f"SELECT ip, ip_num, country, area, {province_sql('country')} AS province, "
                        f"{city_sql('country')} AS city, longitude, latitude FROM g",
        "region_city_split": (f"{base}, {_ods_cte()}\n SELECT province, city, count(*) AS n_rows "
                              "FROM ods GROUP BY province, city"),
        "ods_build": f"{base}, {_full_ods_cte()}\n SELECT * FROM full_ods",
    }


# ---------------------------------------------------------------- business areas
_B32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash_sql(lat: str, lon: str) -> str:
    x = f"least(greatest(CAST(floor((CAST({lon} AS DOUBLE) + 180.0e0) / 360.0e0 * 1048576.0e0) AS BIGINT), 0), 1048575)"
    y = f"least(greatest(CAST(floor((CAST({lat} AS DOUBLE) + 90.0e0) / 180.0e0 * 1048576.0e0) AS BIGINT), 0), 1048575)"
    terms = []
    for i in range(20):
        terms.append(f"((((({x}) >> {i}) & 1)) << {2 * i + 1})")
        terms.append(f"((((({y}) >> {i}) & 1)) << {2 * i})")
    code = "(" + " | ".join(terms) + ")"
    chars = [f"substr('{_B32}', CAST((({code} >> {35 - 5 * k})) & 31 AS INTEGER) + 1, 1)" for k in range(8)]
    return "(" + " || ".join(chars) + ")"


GEOCODE_CTE = """geo_first AS (
 SELECT CAST(-180 + (c_custkey*7919%36000)/100.0e0 AS FLOAT) AS longitude,
        CAST(-90 + (c_custkey*104729%18000)/100.0e0 AS FLOAT) AS latitude, min(c_custkey) AS c
 FROM customer GROUP BY 1, 2),
geocode AS (
 SELECT longitude, latitude,
   CASE WHEN c % 4 = 1 THEN 'oops'
        WHEN c % 4 = 0 THEN '{"status":"1","regeocode":{"addressComponent":{"businessAreas":[[]]}}}'
        ELSE '{"status":"1","regeocode":{"addressComponent":{"businessAreas":[{"name":"BA' || (c % 20)
             || '","id":"' || c || '"},{"name":"BA' || (c % 7) || '","id":"' || c || '"}]}}}' END AS response
 FROM geo_first)"""

COORD_AREAS_CTE = """coords AS (SELECT DISTINCT @KEYS@latitude, longitude FROM SOURCE
   WHERE longitude IS NOT NULL AND latitude IS NOT NULL),
coord_names AS (
 SELECT @KEYS@c.latitude, c.longitude,
   list_filter(CASE WHEN json_valid(g.response)
        THEN json_extract_string(g.response, '$.regeocode.addressComponent.businessAreas[*].name') END,
        lambda x: x IS NOT NULL) AS names
 FROM coords c LEFT JOIN geocode g ON c.longitude = g.longitude AND c.latitude = g.latitude),
coord_areas AS (
 SELECT @KEYS@latitude, longitude, GEOHASH AS geohash, coalesce(array_to_string(names, ','), '') AS areas, names
 FROM coord_names),
library AS (
 SELECT @KEYS@geohash, string_agg(name, ',' ORDER BY name) AS areas FROM (
   SELECT DISTINCT @KEYS@geohash, unnest(names) AS name FROM coord_areas WHERE areas <> '') t
 GROUP BY @KEYS@geohash)"""


def coord_areas_cte(source: str = "ad_log", by: str = "") -> str:
    """Coordinates, their areas and the area library of ``source``, per column ``by`` if given."""
    return (COORD_AREAS_CTE.replace("@KEYS@", f"{by}, " if by else "").replace("SOURCE", source)
            .replace("GEOHASH", geohash_sql("latitude", "longitude")))


def area_queries() -> dict[str, str]:
    cte = coord_areas_cte()
    base = f"WITH {ad_log_cte()}, {GEOCODE_CTE}, {cte}"
    return {
        "coords_distinct": (f"WITH {ad_log_cte()} SELECT DISTINCT CAST(latitude AS DOUBLE) AS latitude, "
                            "CAST(longitude AS DOUBLE) AS longitude, "
                            "CAST(longitude AS VARCHAR) || ',' || CAST(latitude AS VARCHAR) AS location "
                            "FROM ad_log WHERE longitude IS NOT NULL AND latitude IS NOT NULL"),
        "geohash8": (f"WITH {ad_log_cte()} SELECT DISTINCT CAST(latitude AS DOUBLE) AS latitude, "
                     f"CAST(longitude AS DOUBLE) AS longitude, {geohash_sql('latitude', 'longitude')} AS geohash "
                     "FROM ad_log WHERE longitude IS NOT NULL AND latitude IS NOT NULL"),
        "area_json": (f"{base} SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
                      "areas FROM coord_areas"),
        "area_library": f"{base} SELECT geohash, areas FROM library",
        "ods_with_areas": (f"{base} SELECT a.ip, a.mac, a.androidid, a.requestmode, "
                           f"{geohash_sql('a.latitude', 'a.longitude')} AS geohash, b.areas "
                           f"FROM ad_log a LEFT JOIN library b ON {geohash_sql('a.latitude', 'a.longitude')} = b.geohash"),
        "area_lookup": (f"{base}, cells AS (SELECT DISTINCT {geohash_sql('latitude', 'longitude')} AS geohash "
                        "FROM ad_log WHERE longitude IS NOT NULL AND latitude IS NOT NULL) "
                        "SELECT c.geohash, coalesce(b.areas, '') AS areas FROM cells c "
                        "LEFT JOIN library b ON c.geohash = b.geohash"),
    }


# ---------------------------------------------------------------- tags and identity
DICT_CTE = """app_dict AS (SELECT DISTINCT 'XRX' || (p_partkey % 50) AS appid, 'App ' || (p_partkey % 50) AS name
  FROM part WHERE (p_partkey % 50) % 10 <> 0),
device_dict AS (SELECT * FROM (VALUES ('1', 'D00010001'), ('2', 'D00010002'), ('3', 'D00010003'),
  ('4', 'D00010004'), ('WIFI', 'D00020001'), ('4G', 'D00020002'), ('3G', 'D00020003'), ('2G', 'D00020004'),
  ('NETWORKOTHER', 'D00020005'), ('移动', 'D00030001'), ('联通', 'D00030002'), ('电信', 'D00030003'),
  ('OPERATOROTHER', 'D00030004')) v(k, code))"""

_IDS = ("imei", "mac", "idfa", "openudid", "androidid")
IDS_SQL = "list_filter([imei, mac, idfa, openudid, androidid], lambda x: x IS NOT NULL AND regexp_matches(x, '\\S'))"
P3_SQL = " OR ".join(f"({c} IS NOT NULL AND {c} <> '')" for c in _IDS)


def _jsplit_tags(col: str, prefix: str) -> str:
    t = f"regexp_replace({col}, ',+$', '')"
    return (f"CASE WHEN {col} = '' THEN ['{prefix}'] WHEN {t} = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE list_transform(string_split({t}, ','), lambda k: '{prefix}' || k) END")


FAMILY_SQL = {
    "app": "['APP_' || coalesce(appname, app_dict_name, 'null')]",
    "device": ("['CB_' || client_code, 'ISP_' || operator_code, 'NM_' || network_code, "
               "'DT_' || coalesce(devicetype, 0), 'DEVICE_' || coalesce(device, 'null')]"),
    "region": "['PN_' || coalesce(province, 'null'), 'CTN_' || coalesce(city, 'null')]",
    "adtype": "['AT_' || coalesce(adspacetypename, 'null')]",
    "keyword": f"CASE WHEN keywords IS NULL THEN CAST([] AS VARCHAR[]) ELSE {_jsplit_tags('keywords', 'KW_')} END",
    "channel": "['CN_' || coalesce(channelid, 'null')]",
    "age": "['AGE_' || coalesce(age, 'null')]",
    "sex": "['SEX_' || coalesce(sex, 'null')]",
    "area": (f"CASE WHEN regexp_matches(coalesce(areas, ''), '\\S') THEN {_jsplit_tags('areas', 'BA_')} "
             "ELSE CAST([] AS VARCHAR[]) END"),
}


def _ods_ds_cte() -> str:
    return _ods_cte().replace("ods AS (SELECT l.ip,", f"ods AS (SELECT {DS_EXPRESSION.replace('event_ts', 'l.event_ts')} AS ds, l.ip,")


def tag_base(families=None) -> str:
    fams = list(families) if families else list(FAMILY_SQL)
    cte = coord_areas_cte("ods", "ds")
    tags = "list_distinct(list_concat(" + ", ".join(FAMILY_SQL[f] for f in fams) + "))"
    return (f"WITH {ad_log_cte()}, {IP_RANGES_CTE}, {_ods_ds_cte()}, {GEOCODE_CTE}, {cte}, {DICT_CTE},\n"
            f"inp AS (SELECT o.*, lib.areas, ad.name AS app_dict_name,\n"
            f"   coalesce(dc.code, 'D00010004') AS client_code, coalesce(di.code, 'D00030004') AS operator_code,\n"
            f"   coalesce(dn.code, 'D00020005') AS network_code\n"
            f" FROM ods o LEFT JOIN library lib ON {geohash_sql('o.latitude', 'o.longitude')} = lib.geohash AND o.ds = lib.ds\n"
            f" LEFT JOIN app_dict ad ON o.appid = ad.appid\n"
            f" LEFT JOIN device_dict dc ON CAST(coalesce(o.client, 0) AS VARCHAR) = dc.k\n"
            f" LEFT JOIN device_dict di ON o.ispname = di.k\n"
            f" LEFT JOIN device_dict dn ON o.networkmannername = dn.k\n"
            f" WHERE {P3_SQL}),\n"
            f"recs AS (SELECT ds, ids, ids[1] AS main_id, tags FROM (\n"
            f"   SELECT ds, {IDS_SQL} AS ids, {tags} AS tags FROM inp) t WHERE len(ids) > 0)")


def components_cte(recs: str, name: str = "comp") -> str:
    """Connected components by reachability (recursive UNION terminates on cycles)."""
    return (f"{name}_e AS (SELECT DISTINCT main_id AS a, unnest(ids) AS b FROM {recs}),\n"
            f"{name}_u AS (SELECT a, b FROM {name}_e UNION SELECT b, a FROM {name}_e),\n"
            f"{name}_r(node, lbl) AS (SELECT a, a FROM {name}_u UNION "
            f"SELECT u.b, r.lbl FROM {name}_r r JOIN {name}_u u ON r.node = u.a),\n"
            f"{name} AS (SELECT node AS id, min(lbl) AS component FROM {name}_r GROUP BY node)")


def _person_tags(recs: str, comp: str, weight: str = "1.0") -> str:
    return (f"SELECT coalesce(c.component, r.main_id) AS person, unnest(r.tags) AS tag FROM {recs} r "
            f"LEFT JOIN {comp} c ON r.main_id = c.id")


def identity_base() -> str:
    return (f"WITH {ad_log_cte()},\n"
            f"recs AS (SELECT ids, ids[1] AS main_id FROM (SELECT {IDS_SQL} AS ids FROM ad_log WHERE {P3_SQL}) t "
            "WHERE len(ids) > 0)")


def merged_base() -> str:
    return (f"{tag_base()}, {components_cte('recs')},\n"
            "merged AS (SELECT person, tag, (10 * count(*) FILTER (WHERE ds = '" + TODAY_DS + "') + "
            "9 * count(*) FILTER (WHERE ds = '" + HISTORY_DS + "')) / 10.0e0 AS weight FROM ("
            "SELECT r.ds, coalesce(c.component, r.main_id) AS person, unnest(r.tags) AS tag FROM recs r "
            "LEFT JOIN comp c ON r.main_id = c.id) x GROUP BY person, tag)")


_CLASSIFY = [("AT_", "adType"), ("AGE_", "age"), ("APP_", "app"), ("BA_", "businessArea"), ("CN_", "channel")]
_CODES = [("CB_", "D0001000", "client", ["android", "ios", "wp", "other"]),
          ("NM_", "D0002000", "network", ["WIFI", "4G", "3G", "2G", "NETWORKOTHER"]),
          ("ISP_", "D0003000", "operator", ["移动", "联通", "电信", "OPERATOROTHER"])]
_CLASSIFY_LAST = [("DT_", "deviceType"), ("DEVICE_", "deviceModel"), ("KW_", "keyword"),
                  ("PN_", "province"), ("CTN_", "city"), ("SEX_", "sex")]


def classify_sql() -> str:
    field, value = [], []
    for p, f in _CLASSIFY:
        field.append(f"WHEN starts_with(tag, '{p}') THEN '{f}'")
        value.append(f"WHEN starts_with(tag, '{p}') THEN substr(tag, {len(p) + 1})")
    for p, code, f, names in _CODES:
        for k, v in enumerate(names, start=1):
            cond = f"starts_with(tag, '{p}') AND contains(tag, '{code}{k}')"
            field.append(f"WHEN {cond} THEN '{f}'")
            value.append(f"WHEN {cond} THEN '{v}'")
    for p, f in _CLASSIFY_LAST:
        field.append(f"WHEN starts_with(tag, '{p}') THEN '{f}'")
        value.append(f"WHEN starts_with(tag, '{p}') THEN substr(tag, {len(p) + 1})")
    return (f"classified AS (SELECT person, CASE {' '.join(field)} END AS field, "
            f"CASE {' '.join(value)} END AS value, weight FROM merged)")


_FIELDS = ("app", "deviceModel", "deviceType", "client", "sex", "age", "businessArea",
           "operator", "keyword", "adType", "city", "province", "network", "channel")


def profile_queries() -> dict[str, str]:
    mb = merged_base()
    docs = ", ".join(f"coalesce(string_agg('(' || value || ',' || CAST(weight AS VARCHAR) || ')', ',' ORDER BY value, weight) "
                     f"FILTER (WHERE field = '{f}'), '') AS \"{f}\"" for f in _FIELDS)
    return {
        "tag_codec": (f"{mb} SELECT person, string_agg('(' || tag || ',' || CAST(weight AS VARCHAR) || ')', ',' "
                      "ORDER BY tag) AS tags, count(*) AS n_tags FROM merged GROUP BY person"),
        "profile_classify": (f"{mb}, {classify_sql()} SELECT person, field, value, weight FROM classified "
                             "WHERE field IS NOT NULL"),
        "profile_docs": (f"{mb}, {classify_sql()} SELECT person AS _id, {docs} FROM classified GROUP BY person"),
        "tag_decode": f"{mb} SELECT person, tag, weight FROM merged",
    }


def snapshot_queries() -> dict[str, str]:
    base = f"WITH {ad_log_cte()}, {IP_RANGES_CTE}, {_ods_ds_cte()}"
    return {
        "snapshot_read": (f"{base} SELECT ip, appid, requestmode, province, city, ds FROM ods "
                          f"WHERE ds = '{TODAY_DS}'"),
        "sink_key_check": f"{base} SELECT ip, count(*) AS n FROM ods GROUP BY ip HAVING count(*) > 1",
    }


def tag_queries() -> dict[str, str]:
    ib = identity_base()
    today = f"(SELECT * FROM recs WHERE ds = '{TODAY_DS}')"
    hist = f"(SELECT * FROM recs WHERE ds = '{HISTORY_DS}')"
    out = {
        "identified_rows": f"WITH {ad_log_cte()} SELECT imei, mac, idfa, openudid, androidid FROM ad_log WHERE {P3_SQL}",
        "identity_ids": f"{ib} SELECT main_id, array_to_string(ids, ',') AS ids, len(ids) AS n_ids FROM recs",
        "identity_edges": f"{ib} SELECT DISTINCT main_id AS src, unnest(ids) AS dst FROM recs EXCEPT SELECT id, id FROM (SELECT unnest(ids) AS id FROM recs)",
        "identity_components": (f"{ib}, {components_cte('recs')},\n nodes AS (SELECT DISTINCT unnest(ids) AS id FROM recs)\n"
                                "SELECT n.id, coalesce(c.component, n.id) AS component FROM nodes n LEFT JOIN comp c ON n.id = c.id"),
        "identity_records": (f"{ib}, {components_cte('recs')}\n SELECT coalesce(c.component, r.main_id) AS person, r.main_id, "
                             "count(*) AS n_records FROM recs r LEFT JOIN comp c ON r.main_id = c.id GROUP BY ALL"),
        "component_members": (f"{ib}, {components_cte('recs')},\n nodes AS (SELECT DISTINCT unnest(ids) AS id FROM recs),\n"
                              " m AS (SELECT coalesce(c.component, n.id) AS component, n.id AS member FROM nodes n LEFT JOIN comp c ON n.id = c.id)\n"
                              "SELECT component, member, count(*) OVER (PARTITION BY component) AS n_members FROM m"),
        "tag_record": (f"{tag_base()} SELECT main_id, tag, count(*) AS n FROM (SELECT main_id, unnest(tags) AS tag FROM recs) t GROUP BY ALL"),
        "tag_agg": (f"{tag_base()}, t AS {today}, {components_cte('t')}\n"
                    f"SELECT person, tag, CAST(count(*) AS DOUBLE) AS weight FROM ({_person_tags('t', 'comp')}) x GROUP BY ALL"),
        "history_tags": (f"{tag_base()}, h AS {hist}, {components_cte('h')}\n"
                         f"SELECT person, tag, CAST(count(*) AS DOUBLE) AS weight FROM ({_person_tags('h', 'comp')}) x GROUP BY ALL"),
        "tag_decay": (f"{tag_base()}, h AS {hist}, {components_cte('h')}\n"
                      f"SELECT person, tag, 9 * count(*) / 10.0e0 AS weight FROM ({_person_tags('h', 'comp')}) x GROUP BY ALL"),
        "tag_merge": f"{merged_base()} SELECT person, tag, weight FROM merged",
        "dict_lookup": (f"WITH {ad_log_cte()}, {DICT_CTE} SELECT DISTINCT l.appid, d.name FROM ad_log l "
                        "LEFT JOIN app_dict d ON l.appid = d.appid"),
    }
    fams = {"tag_app": ["app"], "tag_device": ["device"], "tag_region": ["region"],
            "tag_simple": ["adtype", "channel", "age", "sex"], "tag_keyword": ["keyword"], "tag_area": ["area"]}
    for name, f in fams.items():
        out[name] = (f"{tag_base(f)} SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM recs) t GROUP BY tag")
    return out


# ---------------------------------------------------------------- skew toolkit
def skew_queries() -> dict[str, str]:
    plain = ("SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey FROM orders o "
             "LEFT JOIN customer c ON o.o_custkey = c.c_custkey")
    ib = identity_base()
    return {
        "skew_hot_keys": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) * 1000 >= (SELECT count(*) FROM orders)",
        "skew_filter_join": (f"{ib}, {components_cte('recs')},\n nodes AS (SELECT DISTINCT unnest(ids) AS id FROM recs),\n"
                             " m AS (SELECT n.id, coalesce(c.component, n.id) AS component FROM nodes n LEFT JOIN comp c ON n.id = c.id)\n"
                             "SELECT a.androidid, a.mac, m.component FROM ad_log a LEFT JOIN m ON a.androidid = m.id"),
        "skew_broadcast_join": plain,
        "skew_two_phase_count": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
        "skew_isolate_join": plain,
        "skew_expand_join": plain,
    }


# ---------------------------------------------------------------- raw log, keyed writes, feeds, functions


def _ods_reports() -> dict[str, str]:
    base = f"WITH {ad_log_cte()}, {IP_RANGES_CTE}, {_ods_cte()}"
    return {
        "ods_report_province_city": f"{base} SELECT province, city, count(*) AS n FROM ods GROUP BY province, city",
        "ods_report_region": (f"{base}, t AS (SELECT province, city, {FUNNEL_SELECT} FROM ods GROUP BY province, city) "
                              f"SELECT province, city, {FUNNEL_OUTER} FROM t"),
    }


def _line_queries() -> dict[str, str]:
    client, order = AD_LOG_EXPRESSIONS["client"], AD_LOG_EXPRESSIONS["adorderid"]
    return {"log_quarantine": (
        "WITH l AS (SELECT CASE WHEN l_orderkey % 41 = 0 THEN 'malformed' WHEN l_orderkey % 43 = 0 THEN 'not an object' "
        "WHEN l_orderkey % 47 = 0 THEN 'wrong' WHEN l_orderkey % 53 = 0 THEN 'extra' ELSE 'record' END AS k, "
        f"{client} AS client, {order} AS adorderid, l_linenumber FROM lineitem) "
        "SELECT CASE WHEN k IN ('wrong', 'extra') THEN 'rescued' ELSE k END AS kind, count(*) AS n, "
        "count(*) FILTER (WHERE k IN ('wrong', 'extra', 'record')) AS n_orders, "
        "sum(client) FILTER (WHERE k IN ('extra', 'record'))::BIGINT AS client_sum, "
        "sum(l_linenumber) FILTER (WHERE k = 'extra')::BIGINT AS extra_sum, count(*) FILTER (WHERE k = 'wrong') AS n_wrong FROM l GROUP BY 1")}


def _store_queries() -> dict[str, str]:
    hist = f"(SELECT * FROM recs WHERE ds = '{HISTORY_DS}')"
    both = f"{tag_base()}, h AS {hist}, {components_cte('recs')}, {components_cte('h', 'old')}"
    texts = " || '|' || ".join(
        f"coalesce(string_agg('(' || value || ',' || CAST(weight AS VARCHAR) || ')', ',' ORDER BY value, weight) "
        f"FILTER (WHERE field = '{f}'), '')" for f in _FIELDS)
    before = classify_sql().replace("classified AS", "classified_old AS").replace("FROM merged", "FROM merged_old")
    merged = merged_base()[len(tag_base()):].replace(f", {components_cte('recs')}", "", 1)
    return {
        "day_touched": (f"{both} SELECT DISTINCT coalesce(c.component, r.main_id) AS person, false AS gone FROM recs r "
                        f"LEFT JOIN comp c ON r.main_id = c.id WHERE r.ds = '{TODAY_DS}' UNION ALL "
                        "SELECT DISTINCT o.component, true FROM old o JOIN comp c ON o.id = c.id WHERE o.component <> c.component"),
        "document_feed": (f"{both}{merged},\n merged_old AS (SELECT person, tag, CAST(count(*) AS DOUBLE) AS weight "
                          f"FROM ({_person_tags('h', 'old')}) x GROUP BY ALL), {classify_sql()}, {before},\n"
                          f" a AS (SELECT person AS _id, {texts} AS doc FROM classified GROUP BY person),\n"
                          f" b AS (SELECT person AS _id, {texts} AS doc FROM classified_old GROUP BY person)\n"
                          "SELECT coalesce(a._id, b._id) AS _id, CASE WHEN b._id IS NULL THEN 'insert' WHEN a._id IS NULL THEN 'delete' "
                          "ELSE 'update' END AS op, a.doc FROM a FULL JOIN b ON a._id = b._id "
                          "WHERE a._id IS NULL OR b._id IS NULL OR a.doc <> b.doc"),
    }


def _small_queries() -> dict[str, str]:
    ib = identity_base()
    key = "CASE WHEN o_custkey % 17 <> 0 THEN o_custkey END"
    return {
        "ip_file_geo": ip_queries()["ip_geo"].replace(", longitude, latitude FROM g", " FROM g"),
        "ip_text": (f"WITH {ad_log_cte()} SELECT DISTINCT ip, {ip_num_sql('ip')} AS ip_num, "
                    f"CASE WHEN {ip_num_sql('ip')} IS NOT NULL THEN ip END AS ip_text FROM ad_log WHERE ip IS NOT NULL AND ip <> ''"),
        "sql_geohash": area_queries()["geohash8"],
        "sql_salted_count": "SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY o_custkey",
        "graph_size": (f"{ib}, e AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM "
                       "(SELECT main_id AS a, unnest(ids) AS b FROM recs) t WHERE a <> b) "
                       "SELECT (SELECT count(*) FROM (SELECT a FROM e UNION SELECT b FROM e) n) AS nodes, count(*) AS edges FROM e"),
        "dict_file_lookup": tag_queries()["dict_lookup"],
        "area_point": area_queries()["area_library"].replace("SELECT geohash, areas FROM library",
                                                             "SELECT geohash, areas FROM library ORDER BY geohash DESC LIMIT 1"),
        "bucketed_person_join": (
            f"{ib}, {components_cte('recs')}, l AS (SELECT ip, requestmode, {IDS_SQL}[1] AS id FROM ad_log WHERE {P3_SQL}) "
            "SELECT l.id, l.ip, l.requestmode, coalesce(c.component, l.id) AS component FROM l LEFT JOIN comp c ON l.id = c.id "
            "WHERE l.id IS NOT NULL"),
        "skew_hot_keys_sketched": skew_queries()["skew_hot_keys"],
        "partition_rows": "SELECT count(*)::BIGINT AS n_rows FROM orders",
        "day_suffixes": ("SELECT strftime(l_shipdate, '%Y%m%d') AS ds, strftime(l_shipdate::DATE - 1, '%Y%m%d') AS before, "
                         "count(*) AS n FROM lineitem GROUP BY 1, 2"),
        "keyed_insert": (
            f"WITH b AS (SELECT {key} AS custkey, o_orderstatus AS status, (o_orderkey % 2)::INTEGER AS batch, count(*) AS n "
            "FROM orders GROUP BY 1, 2, 3),\n"
            "firsts AS (SELECT custkey, min(batch) AS batch FROM b WHERE custkey IS NOT NULL GROUP BY custkey),\n"
            "stored AS (SELECT b.custkey, b.batch, min(status) AS status FROM b JOIN firsts USING (custkey, batch) GROUP BY 1, 2),\n"
            "j AS (SELECT b.*, s.status = b.status AND s.batch = b.batch AS goes_in, s.batch < b.batch AS held "
            "FROM b LEFT JOIN stored s USING (custkey))\n"
            "SELECT custkey, status, 'accepted' AS reason, 1::BIGINT AS n, batch FROM j WHERE goes_in UNION ALL "
            "SELECT custkey, status, CASE WHEN custkey IS NULL THEN 'null key' WHEN held THEN 'stored key' ELSE 'repeated key' END, "
            "n - coalesce(goes_in, false)::BIGINT, batch FROM j WHERE n - coalesce(goes_in, false)::BIGINT > 0"),
    }


def all_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    for more in (_ods_reports, _line_queries, _store_queries, _small_queries):
        out.update(more())
    out.update(report_queries())
    out.update(ip_queries())
    out.update(area_queries())
    out.update(tag_queries())
    out.update(profile_queries())
    out.update(snapshot_queries())
    out.update(skew_queries())
    return {k: (v.replace("WITH ", "WITH RECURSIVE ", 1) if "_r(node, lbl)" in v else v)
            for k, v in out.items()}
