"""Connected components on DataFrames (E5): alternating large-star / small-star.

Algorithm from Kiveris et al., "Connected Components in MapReduce and
Beyond" (SoCC 2014): O(log² n) rounds even on long chains, each round two
``groupBy(min)`` + join passes over the edge list.  Node ids are strings and
the label of a component is its smallest id, so results are deterministic
and independent of partitioning.

Scale notes
-----------
* ``groupBy(node).min`` aggregates partially on the map side, so a hub id
  (one identifier shared by a third of all records) never concentrates its
  edge list in one task.  The minimums are written as a table before the
  edges are joined to them: AQE splits a hub's partition only where both
  inputs of the join are plain shuffles, with no aggregation in between.
* Each round is cut by writing its edges as a Parquet table under the folder
  named by ``spark.checkpoint.dir`` — plans stay short and a lost executor
  recomputes at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize


def _large_star(edges: DataFrame, rows: int = 1 << 62) -> DataFrame:
    sym = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
        edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    mins = _stored(sym.groupBy("u").agg(F.min("v").alias("mn")).select(
        "u", F.least(F.col("u"), F.col("mn")).alias("m")), "cc-mins", rows)
    # duplicates are removed by the small-star step that always follows
    return (sym.where(F.col("v") > F.col("u")).join(mins, "u")
            .select(F.col("v").alias("src"), F.col("m").alias("dst")))


def _small_star(edges: DataFrame, rows: int = 1 << 62) -> DataFrame:
    oriented = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    mins = _stored(oriented.groupBy("u").agg(F.min("v").alias("m")), "cc-mins", rows)
    linked = oriented.join(mins, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    own = mins.select(F.col("u").alias("src"), F.col("m").alias("dst"))
    return linked.unionByName(own).where(F.col("src") != F.col("dst")).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """True when every node has at most one parent and no parent has a parent.

    For small-star output (each edge points from a node to a smaller one)
    this is exactly the fixed point of large-star/small-star: the stars are
    the components and each root is its component's smallest id.  One
    partially aggregated job instead of a confirming extra round.
    """
    marks = (edges.select(F.col("src").alias("n"), F.lit(1).alias("parents"), F.lit(0).alias("is_root"))
             .unionByName(edges.select(F.col("dst").alias("n"), F.lit(0).alias("parents"),
                                       F.lit(1).alias("is_root"))))
    bad = (marks.groupBy("n").agg(F.sum("parents").alias("parents"), F.max("is_root").alias("is_root"))
           .where((F.col("parents") > 1) | ((F.col("parents") >= 1) & (F.col("is_root") == 1))))
    return bad.isEmpty()


ROWS_PER_TASK = 100_000


def _stored(df: DataFrame, name: str, rows: int) -> DataFrame:
    """Materialise a frame of about ``rows`` rows; a small one in few tasks and files."""
    tasks = -(-rows // ROWS_PER_TASK)
    return materialize(df.coalesce(max(1, tasks)) if tasks <= 32 else df, name)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         max_rounds: int = 200) -> DataFrame:
    """(id, component) for every node that appears in ``edges``.

    Self-loops and duplicate/reversed edges are ignored.  Isolated nodes are
    not in the output; callers add them with ``coalesce(component, id)``.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    cur = materialize(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
           .where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
           .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
           .distinct(), "cc-edges")
    rows = cur.count()
    for _ in range(max_rounds):
        # each round reads the previous round's table: lineage never grows
        wide = _stored(_large_star(cur, rows), "cc-round", rows)
        cur = _stored(_small_star(wide, rows), "cc-round", rows)
        if _is_star_forest(cur):
            break
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    # a converged edge set is a forest of stars: (member, root)
    roots = cur.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    members = cur.select(F.col("src").alias("id"), F.col("dst").alias("component"))
    return members.unionByName(roots).distinct()


def graph_summary(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """E5b (diagnostic): one row with the node and distinct-edge counts of a graph."""
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    nodes = e.select(F.lit("node").alias("kind"), F.col("a").alias("x"), F.lit(None).cast("string").alias("y"))
    nodes = nodes.unionByName(e.select(F.lit("node").alias("kind"), F.col("b").alias("x"),
                                       F.lit(None).cast("string").alias("y")))
    pairs = e.select(F.lit("edge").alias("kind"), F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    items = nodes.unionByName(pairs).distinct()
    return items.agg(F.count_if(F.col("kind") == "node").alias("nodes"),
                     F.count_if(F.col("kind") == "edge").alias("edges"))
