"""adsphere — audience analytics for ad-exchange logs, built on PySpark.

Every operator is a pure function ``DataFrame(s) -> DataFrame`` built from
Catalyst expressions; I/O lives in :mod:`adsphere.sources`.

Layout
------
``sources``    table readers: driver tables, the ad-log fixture, dimensions,
               JSON logs, text dictionaries, day snapshots and keyed sinks.
``functions``  column expressions: IP numbers, geohash, location split,
               tag rules, tag-string codec, salts, day suffixes.
``operators``  reusable operators: funnel metrics, IP range join, connected
               components, tag aggregation and decay, profile documents, skew
               joins.
``plans``      the daily jobs composed from operators (ODS, reports, business
               areas, tagging, history merge, profile export).
``streaming``  the same daily jobs driven by a file stream (micro-batches).
"""

__all__ = ["session"]
