"""Merkle manifest of a data set, with inclusion proofs gathered by pointer jumping."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import Steps, ordered, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # the tree over the subroots
HEIGHT_OF_TOP = 64  # above every level of a tree over leaves
NODE = ("tree", "level", "idx")
PATH = "array<struct<before:binary,after:binary>>"


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _leaf(docs: DataFrame, text: Column) -> Column:
    """Hash of one row: every field as its byte count and value, a null one as a dash."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return _digest(F.concat(*[field(text if f == "text" else docs[f]) for f in FIELDS]))


def tampered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """One row per run of at most ``arity`` nodes: (tree, level, up, n, run of digests)."""
    up = F.floor(F.col("idx") / arity).cast("long")
    members = F.sort_array(F.collect_list(F.struct("idx", "digest")))
    runs = nodes.groupBy("tree", "level", up.alias("up"), "n").agg(members.alias("run"))
    return runs.withColumn("run", F.col("run.digest"))


def _parents(runs: DataFrame, arity: int) -> DataFrame:
    return runs.select(
        "tree", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"),
        F.ceil(F.col("n") / arity).cast("long").alias("n"),
        _digest(F.array_join("run", "")).alias("digest"),
    )


def _edges(runs: DataFrame, arity: int, trees: int) -> DataFrame:
    """From every node its siblings before and after it, and its parent (none if that is the root).

    The last node of a tree over leaves is the subroot: a node of the tree at the top, or the root
    if there is one tree only.
    """
    ends, top = F.col("n") <= arity, F.col("tree") == TOP
    joins_top = ends & ~top if trees > 1 else F.lit(False)
    above = F.when(~ends, F.struct("tree", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"))).when(
        joins_top, F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"))
    )
    each = runs.select("tree", "level", "up", "n", "run", F.posexplode("run").alias("place", "digest"))
    side = F.struct(
        F.unhex(F.array_join(F.slice("run", F.lit(1), F.col("place")), "")).alias("before"),
        F.unhex(F.array_join(F.slice("run", F.col("place") + 2, F.size("run")), "")).alias("after"),
    )
    return each.select(
        "tree", "level", (F.col("up") * arity + F.col("place")).alias("idx"),
        above.alias("above"), F.array(side).alias("path"),
    )


def _height() -> Column:
    return F.col("level") + F.when(F.col("tree") == TOP, HEIGHT_OF_TOP).otherwise(0)


def _levels(n: int, arity: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def _build(nodes: DataFrame, widest: int, arity: int, steps: Steps, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored runs of every level, and the one node left of every tree."""
    runs, left = [], nodes.filter("n = 1")
    for level in range(_levels(widest, arity)):
        runs.append(steps.keep(_runs(nodes.filter("n > 1"), arity), f"{name}{level}"))
        nodes = _parents(runs[-1], arity)
        left = left.unionByName(nodes.filter("n = 1"))
    return runs, left


def merkle_manifest(docs: DataFrame, arity: int = 8) -> DataFrame:
    """One row per document: its leaf, subroot, root, proof, and the root its offered row folds to.

    Leaves of a ``lang`` ascend by ``doc_id`` (null first, rows of one id by their leaf); runs of
    ``arity`` nodes hash to their parent until one node is left, the subroot; subroots in order of
    ``lang`` (null first) likewise give the root. Every node starts with the segment of its
    siblings and a pointer to its parent; each round joins the table of nodes with itself, which
    doubles the distance of every pointer and concatenates segments, until all leaves hold their
    whole proof. Rows with an id whose checksum 3 divides are offered with lower-cased text.

    A null or empty text, source or lang is hashed as such; a null id has the checksum of an empty
    text; equal rows are leaves of their own; a text of any length is hashed where it is read and
    goes no further; other columns are not read. One row alone is its own subroot and root with an
    empty proof; an empty table gives no rows.

    Ranks come from a range sort on unique keys, so a hot language or a row repeated many times is
    split. A node of height h has at most the leaves' number / arity**h peers: the side of a join
    that many rows share is as small, and Spark broadcasts it below its own measured threshold.
    """
    spark = docs.sparkSession
    steps = Steps(spark)
    offered = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 0
    text = F.col("text")
    rows = docs.select(
        "doc_id", "lang", F.monotonically_increasing_id().alias("row"),
        _leaf(docs, text).alias("leaf"),
        F.when(offered, _leaf(docs, tampered(text))).alias("offered"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("lang", "doc_id", "leaf", "row")]
    leaves = ordered(rows, order, "rank", steps, "leaves")
    sizes = leaves.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    trees = ordered(sizes, [F.col("lang").asc_nulls_first()], "tree", steps, "trees")
    trees_n, widest = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()

    own = trees.select("tree", "n", "first", F.col("lang").alias("tree_lang"))
    placed = leaves.join(own, F.col("lang").eqNullSafe(F.col("tree_lang"))).select(
        "tree", F.lit(0).alias("level"), (F.col("rank") - F.col("first")).alias("idx"), "n",
        F.col("leaf").alias("digest"), "doc_id", "offered",
    )
    placed = steps.keep(placed, "placed")
    runs, subroots = _build(placed.select("tree", "level", "idx", "n", "digest"), widest, arity, steps, "runs")
    subroots = steps.keep(subroots.select("tree", "digest"), "subroots")
    tops = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
        F.lit(trees_n).cast("long").alias("n"), "digest",
    )
    top_runs, root = _build(tops, trees_n, arity, steps, "top")
    edges = None
    for level in [*runs, *top_runs]:
        more = _edges(level, arity, trees_n)
        edges = more if edges is None else edges.unionByName(more)

    node = F.when(F.col("n") > 1, F.struct("tree", "level", "idx")).otherwise(
        F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"))
    )
    starts = placed.select(node.alias("node"), "tree", "doc_id", F.col("digest").alias("leaf"), "offered")
    if edges is None:  # at most one row
        held = starts.select("doc_id", "leaf", "offered", "tree", F.expr(f"cast(array() as {PATH})").alias("path"))
    else:
        held = _jump(edges, starts, _levels(widest, arity) + _levels(trees_n, arity), steps)

    named = subroots.withColumnRenamed("digest", "subroot")
    one = root.first()  # of one digest
    whole = held.join(named, "tree").withColumn("root", F.lit(one.digest if one else None).cast("string"))
    hexes = F.transform("path", lambda p: F.concat(F.hex(p["before"]), F.hex(p["after"])))
    fold = F.aggregate(
        "path",
        F.coalesce("offered", "leaf"),
        lambda now, p: _digest(F.concat(F.lower(F.hex(p["before"])), now, F.lower(F.hex(p["after"])))),
    )
    done = whole.withColumns({"proof_sha256": _digest(F.lower(F.array_join(hexes, ""))), "folded_root": fold})
    return done.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _jump(edges: DataFrame, starts: DataFrame, longest: int, steps: Steps) -> DataFrame:
    """(doc_id, leaf, offered, tree, path) with the whole path of every leaf.

    Nodes are stored by height: the pointers of round r reach at least 2**r up, so the other
    side of the self-join reads only the few nodes from that height on.
    """
    spark, key = edges.sparkSession, F.struct(*NODE).alias("node")
    inner = edges.select(_height().alias("height"), key, "above", "path")
    path = steps.path("nodes0")
    inner.write.mode("overwrite").partitionBy("height").parquet(path)
    schema = inner.select("node", "above", "path", "height").schema
    nodes = spark.read.schema(schema).parquet(path)
    low = starts.join(nodes.withColumnRenamed("node", "at"), F.col("node") == F.col("at")).select(
        "doc_id", "leaf", "offered", "tree", "above", "path"
    )
    held = steps.keep(low, "held0")
    reach, turn = 1, 0
    while reach < longest:
        turn += 1
        far = nodes.filter(F.col("height") >= reach).select(
            F.col("node").alias("at"), F.col("above").alias("further"), F.col("path").alias("rest")
        )

        def jumped(rows: DataFrame, far: DataFrame = far) -> DataFrame:
            columns = [c for c in rows.columns if c not in ("above", "path")]
            move = rows.filter("above is not null").join(far, F.col("above") == F.col("at"))
            moved = move.select(*columns, F.col("further").alias("above"), F.concat("path", "rest").alias("path"))
            return moved.unionByName(rows.filter("above is null").select(*columns, "above", "path"))

        later, reach = steps.keep(jumped(held), f"held{turn}"), reach * 2
        if reach < longest:
            path = steps.path(f"nodes{turn}")
            jumped(nodes).select(*schema.names).write.mode("overwrite").partitionBy("height").parquet(path)
            nodes = spark.read.schema(schema).parquet(path)
        steps.drop(f"held{turn - 1}")
        held = later
    return held


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest(table(spark, folder, "documents"))
