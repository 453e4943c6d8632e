"""Sharding over fixed virtual slots with a versioned slot-to-shard map (operator 5).

Every record hashes (by ``doc_id``, size and the text's crc32, so that rows which share an id, or
have none, are spread as well) into one of ``n_slots`` virtual slots; that never changes.  What changes is the map from slots to shards: version 1 deals the slots
out evenly by number, and every rebalancing writes one more version that moves only the
slots it has to.  ``rebalance`` looks at nothing but the bytes per slot (``n_slots`` rows,
whatever the corpus holds), keeps a shard's largest slots up to the mean load and gives
the rest, largest first, to the least loaded shard.

The law that holds is ``bytes``: shard sizes come out near equal, because the slots that
move last are the smallest ones.  The map has ``n_slots`` rows, a fixed number, so it is
broadcast.  A record's place in its shard is the number of rows in the shard's earlier
slots plus its rank inside its own slot, so no task ever numbers a whole shard.

Defined cases: a NULL text has no bytes (size 16, crc32 0); rows with a NULL or repeated
``doc_id`` are dealt by their texts; rows that are equal in id and text share a slot, each with a
place of its own; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .tables import text_or_empty

N_SLOTS = 4096
N_SHARDS = 40
ROW_OVERHEAD = 16  # bytes counted per record besides its text


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every document."""
    return docs.select(
        "doc_id",
        (F.octet_length(text_or_empty()) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32")).withColumn(
            "virtual_slot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(n_slots)).cast("int"))


def slot_loads(recs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(virtual_slot, bytes, n_rows) for all slots, empty ones included."""
    spark = recs.sparkSession
    slots = spark.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    sums = recs.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))
    return (slots.join(F.broadcast(sums), "virtual_slot", "left")  # n_slots rows at most
            .select("virtual_slot", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
                    F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")))


def initial_map(loads: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Version 1: slot number modulo the shard count, blind to the data."""
    return loads.select("virtual_slot", "bytes", "n_rows",
                        F.pmod("virtual_slot", F.lit(n_shards)).cast("int").alias("shard"),
                        F.lit(1).alias("version"))


def rebalance(slot_map: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map: slots over a shard's fair share move, the rest stay.

    Also grows (or shrinks) the shard set: slots of shards that are no more always move,
    and a new shard starts empty.
    """
    mean = F.sum("bytes").over(Window.partitionBy()) / F.lit(float(n_shards))
    largest_first = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "virtual_slot")
    judged = (slot_map.withColumn("mean", mean)
              .withColumn("run", F.sum("bytes").over(largest_first))
              .withColumn("stays", ((F.col("run") <= F.col("mean")) | (F.col("bytes") == 0))
                          & (F.col("shard") < n_shards)))
    # one row holding the n_slots slots (a fixed number): fold the movers into the least loaded shards
    state = judged.groupBy().agg(
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
        F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct("bytes", "virtual_slot"))),
                     asc=False).alias("movers"))
    moved = state.selectExpr(f"""
        explode(aggregate(
          movers,
          named_struct(
            'loads', transform(sequence(0, {n_shards - 1}),
                               s -> aggregate(filter(kept, k -> k.shard = s), 0L, (a, k) -> a + k.bytes)),
            'moves', cast(array() as array<struct<virtual_slot:int,shard:int>>)),
          (acc, m) -> transform(array(array_position(acc.loads, array_min(acc.loads)) - 1), t -> named_struct(
            'loads', transform(acc.loads, (l, i) -> if(i = t, l + m.bytes, l)),
            'moves', concat(acc.moves, array(named_struct('virtual_slot', m.virtual_slot,
                                                          'shard', cast(t as int))))))[0]
        ).moves) as mv""").select("mv.virtual_slot", F.col("mv.shard").alias("new_shard"))
    return (slot_map.join(F.broadcast(moved), "virtual_slot", "left")  # n_slots rows at most
            .select("virtual_slot", "bytes", "n_rows", F.coalesce("new_shard", "shard").alias("shard"),
                    (F.col("version") + 1).alias("version")))


def store_map(versions: list[DataFrame]) -> DataFrame:
    """All versions of a map as one stored table (version, virtual_slot, shard, bytes, n_rows)."""
    out = versions[0]
    for v in versions[1:]:
        out = out.unionByName(v)
    return materialize(out.coalesce(1), "shard-map")


def place(recs: DataFrame, stored: DataFrame, version: int) -> DataFrame:
    """Shard and gapless place in it of every record, under one version of the stored map."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    current = (stored.where(F.col("version") == version)
               .select("virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("base")))
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (recs.withColumn("rank", F.row_number().over(in_slot))
            .join(F.broadcast(current), "virtual_slot")  # n_slots rows
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("rank") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"),
                    "virtual_slot", F.lit(version).alias("map_version")))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> DataFrame:
    """Records placed in ``n_shards`` shards of near equal size; see the module's text."""
    recs = records(docs, n_slots)
    loads = materialize(slot_loads(recs, n_slots).coalesce(1), "slot-loads")
    first = initial_map(loads, n_shards)
    stored = store_map([first, rebalance(first, n_shards)])
    return place(recs, stored, version=2)
