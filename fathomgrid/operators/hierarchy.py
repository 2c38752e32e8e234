"""Parent-child links to full hierarchies by pointer doubling.

Each node holds a pointer to an ancestor. A round joins the unresolved nodes
with the pointers of their ancestors and so doubles the distance they jump: a
tree of depth d takes about log2(d) rounds, whatever its width. Nodes that stay
unresolved when a round resolves nothing lie on a cycle or below one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid import storage

RESULT = "key string, root_key string, depth int, in_cycle int"


def _edges(links: DataFrame) -> DataFrame:
    """Nodes with their parent; parents that are no nodes count as none."""
    nodes = links.select("key", "parent")
    known = links.select(F.col("key").alias("parent")).withColumn("known", F.lit(True))
    return nodes.join(known, "parent", "left").select("key", F.when(F.col("known"), F.col("parent")).alias("parent"))


def _double(state: DataFrame, path: bool) -> DataFrame:
    """One round: unresolved nodes take over the pointer of the node they point to."""
    hop = state.select(
        F.col("key").alias("anc"), F.col("anc").alias("anc2"), F.col("dist").alias("dist2"), F.col("root").alias("root2"),
        *([F.col("path").alias("path2")] if path else []),
    )
    moved = state.where(F.col("root").isNull()).join(hop, "anc").select(
        "key", F.col("anc2").alias("anc"), (F.col("dist") + F.col("dist2")).alias("dist"), F.col("root2").alias("root"),
        *([F.concat("path2", "path").alias("path")] if path else []),
    )
    return state.where(F.col("root").isNotNull()).unionByName(moved)


def _resolve(state: DataFrame, name: str, path: bool = False) -> tuple[DataFrame, int, list[str]]:
    """Double until all nodes are resolved or a round resolves none.

    state: key, anc, dist, root; a resolved node points to itself with dist the
    steps to its root. Depths in a forest have no gaps, so a round that
    resolves nothing leaves only nodes that never reach a root.
    """
    is_open = F.col("root").isNull()
    state, at, left = storage.materialise_counted(state, name, is_open)
    used = [at]
    while left:
        before = left
        state, at, left = storage.materialise_counted(_double(state, path), name, is_open)
        used.append(at)
        if len(used) > 2:
            storage.remove(state.sparkSession, used.pop(-3))
        if left == before:
            break
    return state, left, used


def _cycle_nodes(open_nodes: DataFrame, left: int) -> tuple[DataFrame, list[str]]:
    """Nodes on cycles with the smallest key of their cycle.

    open_nodes: key, parent, every parent among the keys; left: their number.
    A jump of at least that many steps lands on a cycle from everywhere, and the
    landing places are all of its nodes: a jump permutes a cycle. The minimum
    over a window as long as the jump covers the cycle.
    """
    state, at = storage.materialise(open_nodes.select("key", F.col("parent").alias("anc"), F.least("key", "parent").alias("low")), "cycle")
    used, span = [at], 1
    while span < left:
        hop = state.select(F.col("key").alias("anc"), F.col("anc").alias("anc2"), F.col("low").alias("low2"))
        state, at = storage.materialise(
            state.join(hop, "anc").select("key", F.col("anc2").alias("anc"), F.least("low", "low2").alias("low")), "cycle"
        )
        used.append(at)
        span *= 2
        if len(used) > 2:
            storage.remove(state.sparkSession, used.pop(-3))
    on = state.join(state.select(F.col("anc").alias("key")).distinct(), "key", "left_semi")
    return on.select("key", "low"), used


def hierarchy(links: DataFrame, with_path: bool = False) -> DataFrame:
    """Root, depth and cycle state of every node; optionally its path.

    links: key, parent (both string). Rows with a null key are left out; of
    repeated keys the smallest parent counts. A null or unknown parent makes a
    root. Columns: key, root_key, depth, in_cycle (1 on a cycle, a self-parent
    too, 2 below one, else 0), and with_path the keys from the root (or from
    the cycle's node that is reached) down to the node as `path`. root_key of
    nodes on or below a cycle is its smallest key; depth counts the steps to
    the root or to the cycle. Extra columns are ignored; an empty table gives
    an empty result. The path of a node is as long as its depth; leave it out
    for trees that degenerate into long chains.
    """
    spark = links.sparkSession
    clean = links.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("parent").alias("parent"))
    edges, edges_at = storage.materialise(_edges(clean), "edges")
    is_root = F.col("parent").isNull()
    first = edges.select(
        "key", F.when(is_root, F.col("key")).otherwise(F.col("parent")).alias("anc"),
        F.when(is_root, 0).otherwise(1).alias("dist"), F.when(is_root, F.col("key")).alias("root"),
        *([F.array("key").alias("path")] if with_path else []),
    )
    state, left, used = _resolve(first, "tree", with_path)
    path = ["path"] if with_path else []
    done = state.where(F.col("root").isNotNull()).select("key", F.col("root").alias("root_key"), F.col("dist").alias("depth"), F.lit(0).alias("in_cycle"), *path)
    if left:
        inside = edges.join(state.where(F.col("root").isNull()).select("key"), "key", "left_semi")
        on, more = _cycle_nodes(inside, left)
        marked = inside.join(on, "key", "left")
        at_cycle = F.col("low").isNotNull()
        again = marked.select(
            "key", F.when(at_cycle, F.col("key")).otherwise(F.col("parent")).alias("anc"),
            F.when(at_cycle, 0).otherwise(1).alias("dist"), F.when(at_cycle, F.col("key")).alias("root"),
            *([F.array("key").alias("path")] if with_path else []),
        )
        below, _, more2 = _resolve(again, "below", with_path)
        lows = on.select(F.col("key").alias("root"), "low")
        cyclic = below.join(lows, "root").select(
            "key", F.col("low").alias("root_key"), F.col("dist").alias("depth"), F.when(F.col("dist") == 0, 1).otherwise(2).alias("in_cycle"), *path
        )
        done = done.unionByName(cyclic)
        used = [*more[:-1], *more2[:-1], *used]
    for p in (edges_at, *used[:-1]):
        storage.remove(spark, p)
    return done


def descendants(tree: DataFrame) -> DataFrame:
    """All (ancestor, descendant, distance) pairs of a `hierarchy(..., with_path=True)`.

    A node counts as its own descendant at distance 0. The output is as large
    as the sum of all depths, which is the size of the answer itself.
    """
    return tree.select(
        F.col("key").alias("descendant"), F.posexplode("path").alias("at", "ancestor"), F.size("path").alias("n")
    ).select("ancestor", "descendant", (F.col("n") - 1 - F.col("at")).alias("distance"))
