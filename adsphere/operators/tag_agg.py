"""Identity graph and tag aggregation in long form.

Person-level data is kept long — one row per (person, tag) and per
(person, id) — so no person, however many records or ids it gathers, is ever
collected into one row.  Weights are summed with partial aggregation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components

DEFAULT_DECAY = 0.9  # history weight coefficient (configurable)
# Weights are decimals: sums do not depend on the order of rows, a decayed weight keeps 18
# digits, and only what leaves the pipeline becomes a double.
WEIGHT = "decimal(28,18)"


def identity_edges(records: DataFrame) -> DataFrame:
    """Main id → every other id of the record, distinct, no self-loops."""
    return (records.select(F.col("main_id").alias("src"), F.explode("ids").alias("dst"))
            .where(F.col("src") != F.col("dst")).distinct())


def assign_person(records: DataFrame, components: DataFrame, key: str = "main_id") -> DataFrame:
    """J6 + E6: person = component label of the key (its own id when isolated)."""
    comp = components.select(F.col("id").alias(key), F.col("component"))
    return (records.join(comp, key, "left")
            .withColumn("person", F.coalesce(F.col("component"), F.col(key))).drop("component"))


def sum_tags(tagged: DataFrame) -> DataFrame:
    """A10: (person, tag, weight) summed; input rows carry their own weight."""
    return tagged.groupBy("person", "tag").agg(F.sum("weight").cast(WEIGHT).alias("weight"))


def tags_per_main_id(records: DataFrame) -> DataFrame:
    """(main_id as person, tag, weight): records pre-aggregated before any join.

    A main id shared by a third of all records reaches the next shuffle as
    one row per distinct tag (partial aggregation), not one row per record.
    """
    return (records.select(F.col("main_id").alias("person"), F.explode("tags").alias("tag"))
            .groupBy("person", "tag").agg(F.count(F.lit(1)).cast(WEIGHT).alias("weight")))


RECORDS_PER_TASK = 200_000
HOT_RECORDS = 1_000_000  # the records of a key with more are summed in several tasks
_SEPARATOR = "\x01"


def _packed(tags):
    """``tags`` as one text, which takes half the bytes of the list in a shuffle; NULL where the text would not give them back."""
    text = F.array_join(tags, _SEPARATOR, _SEPARATOR)  # a NULL tag brings a separator too many
    separators = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(_SEPARATOR), F.lit("")))
    return F.when((F.size(tags) > 0) & (separators == F.size(tags) - 1), text)


def packed_tags(records: DataFrame, key: str = "main_id") -> DataFrame:
    """(key, _text, _tags) of records: their tags as one text or, where they hold its separator, as they are."""
    packed = records.select(key, _packed(F.col("tags")).alias("_text"), "tags")
    return packed.select(key, "_text", F.when(F.col("_text").isNull(), F.col("tags")).alias("_tags"))


def _unpacked():
    return F.explode(F.coalesce(F.split("_text", _SEPARATOR), F.col("_tags"))).alias("tag")


def _tasks(spark, rows: int, per_task: int, multiple: int = 1) -> int:
    """Tasks for so many rows: those of any shuffle, unless the rows are few or more than they should take."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(usual, -(-rows // (per_task // 20))), -(-rows // per_task), 1)
    return -(-tasks // multiple) * multiple


def count_tags(packed: DataFrame, key: str, rows: int, hot: DataFrame | None = None, buckets: int = 1) -> DataFrame:
    """(key, tag, n) of :func:`packed_tags`: whole records are dealt by their key and become long rows only there.

    Records of a key stand together when their tags are counted, so that neither the long rows nor their partial
    counts are shuffled.  A task's keys fall into one of ``buckets`` (by ``xxhash64``).  Records of the ``hot`` keys
    (a column of few keys) are counted where they are and their counts summed, then dealt by bucket, of which
    several tasks may hold one: no key has to fit one task.
    """
    def counted(df, *keys):
        return df.select(*keys, _unpacked()).groupBy(*keys, "tag").agg(F.count(F.lit(1)).alias("n")).select(key, "tag", "n")
    tasks = _tasks(packed.sparkSession, rows, RECORDS_PER_TASK, buckets)
    rest = packed if hot is None else packed.join(F.broadcast(hot.select(key)), key, "left_anti")
    dealt = (rest.withColumn("_task", F.pmod(F.xxhash64(key), F.lit(tasks)).cast("int"))
             .repartitionById(tasks, F.col("_task")).sortWithinPartitions(key))
    out = counted(dealt, "_task", key)
    if hot is None:
        return out
    summed = counted(packed.join(F.broadcast(hot.select(key)), key, "left_semi"), key)
    if buckets > 1:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        summed = summed.withColumn("_bucket", bucket).hint("rebalance", F.col("_bucket")).drop("_bucket")
    return out.unionByName(summed)


def hot_keys_of(counts: DataFrame, key: str, rows: int, limit: int | None = None) -> DataFrame | None:
    """The keys of more than ``limit`` of ``rows`` records by ``counts`` (key, n), stored; None where there is none."""
    limit = HOT_RECORDS if limit is None else limit
    if rows <= limit:
        return None
    hot = materialize(counts.groupBy(key).agg(F.sum("n").alias("n")).where(F.col("n") > limit).select(key), "hot-keys")
    return None if hot.isEmpty() else hot


def main_id_counts(records: DataFrame) -> DataFrame:
    """(main_id, n): how many records have each main id."""
    return records.groupBy("main_id").agg(F.count(F.lit(1)).alias("n"))


def tags_per_main_record(records: DataFrame) -> DataFrame:
    """(main_id, tag, n) of records."""
    rows = records.count()
    return count_tags(packed_tags(records), "main_id", rows, hot_keys_of(main_id_counts(records), "main_id", rows))


def tags_per_person(records: DataFrame, labels: DataFrame, counts: DataFrame | None = None, buckets: int = 1) -> DataFrame:
    """(person, tag, weight) of records whose main ids have ``labels`` (id, component), or are their own.

    A record meets its label before its tags become rows, and its tags travel as one text
    (:func:`count_tags`).  Pass stored labels: AQE then splits the partition of a hot main id.
    ``counts`` are the stored :func:`main_id_counts`, if there are.
    """
    label = labels.select(F.col("id").alias("main_id"), F.col("component"))

    def labelled(df):
        person = F.coalesce("component", "main_id").alias("person")
        return df.join(label, "main_id", "left").select(person, *[c for c in df.columns if c != "main_id"])
    rows = records.count()
    hot = hot_keys_of(labelled(main_id_counts(records) if counts is None else counts), "person", rows)
    tags = count_tags(labelled(packed_tags(records)), "person", rows, hot, buckets)
    return tags.select("person", "tag", F.col("n").cast(WEIGHT).alias("weight"))


def relabel(df: DataFrame, components: DataFrame) -> DataFrame:
    """Replace ``person`` by its component label (kept when the id is isolated)."""
    label = components.select(F.col("id").alias("person"), F.col("component"))
    return (df.join(label, "person", "left")
            .withColumn("person", F.coalesce(F.col("component"), F.col("person"))).drop("component"))


def person_profile(records: DataFrame):
    """Components over one day's records; returns (tags, ids) long frames.

    ``records`` has ``main_id``, ``ids`` and ``tags`` (each tag weighs 1.0).
    """
    comps = materialize(connected_components(identity_edges(records)), "person-components")
    tags = tags_per_person(records, comps)
    ids = relabel(records.select(F.col("main_id").alias("person"), F.explode("ids").alias("id")).distinct(),
                  comps).distinct()
    return tags, ids


def decay(tags: DataFrame, coefficient: float = DEFAULT_DECAY) -> DataFrame:
    """Every history weight times the coefficient."""
    exact = F.col("weight").cast(WEIGHT) * F.lit(Decimal(str(coefficient)))
    return tags.withColumn("weight", exact.cast(WEIGHT))


def merge_history(history_tags: DataFrame, history_ids: DataFrame, today_records: DataFrame,
                  coefficient: float = DEFAULT_DECAY):
    """E8 + U1: decay → union with today → components over both days → sum.

    Yesterday's persons enter as (person, id) edges, today's records as
    (main id, id) edges; components over their union give the same groups
    as first grouping today's records into persons and then merging, so
    today's records are not grouped twice.  Two people merged today carry
    their history along.
    """
    today_edges = identity_edges(today_records)
    edges = history_ids.select(F.col("person").alias("src"), F.col("id").alias("dst")).unionByName(today_edges)
    comps = connected_components(edges)
    tags = decay(history_tags, coefficient).unionByName(tags_per_main_id(today_records))
    ids = history_ids.unionByName(today_records.select(F.col("main_id").alias("person"),
                                                       F.explode("ids").alias("id")))
    return sum_tags(relabel(tags, comps)), relabel(ids.distinct(), comps).distinct()


def merge_in_one_pass(records: DataFrame, today_ds: str, coefficient: float = DEFAULT_DECAY):
    """E8 for two days of raw records at once: components over both days' ids,
    then ``today_count + coefficient × history_count`` per person and tag.

    Equal to decaying yesterday's persons and merging them with today
    (:func:`merge_history`) — yesterday's persons are exactly the components
    of yesterday's records — with one component pass instead of two.
    ``records`` carries ``ds``; rows of other days are history.
    """
    comps = connected_components(identity_edges(records))
    today = F.col("ds") == F.lit(today_ds)
    per_main = (records.select(F.col("main_id").alias("person"), F.explode("tags").alias("tag"),
                               today.alias("_today"))
                .groupBy("person", "tag")
                .agg(F.count_if(F.col("_today")).alias("t"), F.count_if(~F.col("_today")).alias("h"))
                .select("person", "tag", (F.col("t").cast(WEIGHT) + (
                    F.col("h").cast(WEIGHT) * F.lit(Decimal(str(coefficient)))).cast(WEIGHT)).cast(WEIGHT).alias("weight")))
    ids = records.select(F.col("main_id").alias("person"), F.explode("ids").alias("id")).distinct()
    return sum_tags(relabel(per_main, comps)), relabel(ids, comps).distinct()


def as_doubles(tags: DataFrame) -> DataFrame:
    """Weights as doubles, for output."""
    return tags.withColumn("weight", F.col("weight").cast("double"))


def component_members(components: DataFrame) -> DataFrame:
    """A12 in long form: (component, member, n_members) — the group size comes
    from a partial-aggregated count joined back, not from collecting a list."""
    components = materialize(components, "component-ids")
    # stored, so that both join inputs are plain shuffles and AQE can split a hub's component
    sizes = materialize(components.groupBy("component").agg(F.count(F.lit(1)).alias("n_members")), "component-sizes")
    return components.select("component", F.col("id").alias("member")).join(sizes, "component")
