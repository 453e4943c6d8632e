"""Secret scan with corpus-wide ownership frequency (operator 10), DataFrame functions only.

Three kinds of spans are found in every whole text, leftmost first and without overlap
within a kind: ``assign`` (a keyword, ``:`` or ``=``, and a value of 8 or more characters),
``access`` (an ``AKIA`` key id of 16 or more) and ``hex`` (a run of 32 or more hex digits).
Positions come from the text between matches: ``split`` and ``regexp_extract_all`` run the
same leftmost scan, so the lengths of pieces and matches add up to offsets.

Each found value is then judged over the whole corpus.  Hashes of the values are counted
by distinct repositories (documents) and distinct owners (``source``): a value that many
owners carry is a widely copied ``example``; one that stays with few owners and looks
random is ``live``.  Live values are then looked for in places where no keyword announces
them, which adds spans of kind ``copy``.

Scale: the texts are read once; what is stored and shuffled is spans and value hashes.
Owners are counted by two nested aggregations that combine map-side, so a value found in a
third of all documents costs one row per task and owner.  The verdicts are stored before
they are joined, so both join sides are plain shuffles that AQE can split.

Defined cases: a NULL text is empty; an empty text has no spans and the digest of the empty
string; NULL sources count together as one owner; repeated rows are scanned each by itself;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import text_or_empty

#: kind, pattern, group that holds the value, least length of that value.  The two plain
#: runs carry their least length in the pattern: a shorter run cannot hold a longer match.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Runs in which a known value may stand without a keyword.
BARE = r"[A-Za-z0-9+/_.=-]{8,}"

EXAMPLE_OWNERS = 3  # a value held by this many owners is a copied example
LIVE_DISTINCT = 6   # a live-looking value has this many distinct characters, a digit among them


def _matches(pattern: str, group: int, order: int) -> str:
    """SQL: all matches of ``pattern`` in ``t`` as array<struct<start,ord,end,value>>."""
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    values = (f"regexp_extract_all(t, '{p}', {group})" if group else "transform(m, x -> x)")
    return f"""
      transform(array(regexp_extract_all(t, '{p}', 0)), m -> if(size(m) = 0,
        cast(array() as array<struct<start:int,ord:int,end:int,value:string>>),
        transform(array(split(t, '{p}', -1)), pieces -> transform(array({values}), v ->
          aggregate(sequence(0, size(m) - 1),
            named_struct('at', 0, 'out', cast(array() as array<struct<start:int,ord:int,end:int,value:string>>)),
            (acc, i) -> named_struct(
              'at', acc.at + length(pieces[i]) + length(m[i]),
              'out', concat(acc.out, array(named_struct(
                 'start', acc.at + length(pieces[i]), 'ord', {order},
                 'end', acc.at + length(pieces[i]) + length(m[i]), 'value', v[i]))))
          ).out)[0])[0]))[0]"""


def _at_least(least: int):
    return lambda span: F.length(span["value"]) >= least


def scan(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, source, base, bare): found spans and bare candidate runs of every text."""
    out = docs.select("doc_id", "source", text_or_empty().alias("t"))
    for i, (kind, pattern, group, least) in enumerate(KINDS):
        out = out.withColumn(kind, F.filter(F.expr(_matches(pattern, group, i)), _at_least(least)))
    base = F.array_sort(F.concat(*[F.col(k[0]) for k in KINDS]))
    bare = F.filter(F.expr(_matches(BARE, 0, len(KINDS))),
                    lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return out.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "source",
                      base.alias("base"), bare.alias("bare"))


def _hashed(column: str) -> F.Column:
    return F.sha2(F.col(column), 256)


def ownership(scanned: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners, verdict) of every value found by keyword or shape."""
    found = scanned.select("doc_id", "source", F.explode("base").alias("s")).select(
        "doc_id", F.coalesce("source", F.lit("")).alias("owner"), _hashed("s.value").alias("hash"),
        ((F.size(F.array_distinct(F.split("s.value", ""))) >= LIVE_DISTINCT)
         & F.col("s.value").rlike("[0-9]")).alias("random"))
    repos = found.groupBy("hash", "owner", "doc_id").agg(F.max("random").alias("random"))
    owners = repos.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"), F.max("random").alias("random"))
    counts = owners.groupBy("hash").agg(F.sum("n").alias("n_repositories"),
                                        F.count(F.lit(1)).alias("n_owners"), F.max("random").alias("random"))
    verdict = (F.when(F.col("n_owners") >= EXAMPLE_OWNERS, "example")
               .when(F.col("random"), "live").otherwise("weak"))
    return counts.select("hash", "n_repositories", "n_owners", verdict.alias("verdict"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, spans) of every row; spans hold start, ord, end, value and verdict, in order.

    ``ord`` 0–2 are the kinds of :data:`KINDS`, 3 is ``copy``.
    """
    scanned = materialize(scan(docs), "secret-scan")
    verdicts = materialize(ownership(scanned), "secret-owners")
    spans = scanned.select("row_id", F.explode("base").alias("s")).select("row_id", "s.*")
    bare = (scanned.where((F.size("bare") > 0))
            .select("row_id", "base", F.explode("bare").alias("s"))
            .where(~F.exists("base", lambda b: (b["start"] < F.col("s.end")) & (F.col("s.start") < b["end"])))
            .select("row_id", "s.*"))
    judged = (spans.unionByName(bare).withColumn("hash", _hashed("value"))
              .join(verdicts, "hash", "left")
              .where((F.col("ord") < len(KINDS)) | (F.col("verdict") == "live"))
              .groupBy("row_id").agg(F.array_sort(F.collect_list(
                  F.struct("start", "ord", "end", "value", "verdict", "n_owners"))).alias("spans")))
    none = F.expr("cast(array() as array<struct<start:int,ord:int,end:int,value:string,verdict:string,n_owners:bigint>>)")
    return (scanned.select("row_id", "doc_id").join(judged, "row_id", "left")
            .select("row_id", "doc_id", F.coalesce("spans", none).alias("spans")))


def _joined(spans: F.Column) -> F.Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS], F.lit("copy"))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, all spans, and counts per verdict."""
    f = find_secrets(docs)
    count = lambda i: F.size(F.filter("spans", lambda s: s["ord"] == i)).cast("long")
    verdict = lambda v: F.size(F.filter("spans", lambda s: s["verdict"] == v)).cast("long")
    return f.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.filter("spans", lambda s: s["ord"] < len(KINDS))), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        verdict("live").alias("n_live"), verdict("example").alias("n_example"))


PLACEHOLDER = "[SECRET]"


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span not judged a widely copied example replaced.

    Overlapping spans become one placeholder; all other text and columns stay as they are.
    """
    packed = materialize(docs.select(F.struct(*docs.columns).alias("_doc"),
                                     F.monotonically_increasing_id().alias("_row")), "secret-docs")
    found = find_secrets(packed.select(F.col("_row").alias("doc_id"), "_doc.text", "_doc.source"))
    cut = (found.withColumn("spans", F.filter("spans", lambda s: s["verdict"] != "example"))
           .where(F.size("spans") > 0).select(F.col("doc_id").alias("_row"), "spans"))
    clean = F.expr(f"""
      transform(array(aggregate(spans, named_struct('at', 0, 'out', cast(array() as array<string>)),
        (acc, s) -> named_struct(
          'at', greatest(acc.at, s.end),
          'out', if(s.start < acc.at, acc.out,
                    concat(acc.out, array(substring(_doc.text, acc.at + 1, s.start - acc.at), '{PLACEHOLDER}')))))),
        r -> concat(array_join(r.out, ''), substring(_doc.text, r.at + 1)))[0]""")
    out = packed.join(cut, "_row", "left")
    text = F.when(F.col("spans").isNull(), F.col("_doc.text")).otherwise(clean).alias("text")
    return out.select(*[text if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns])
