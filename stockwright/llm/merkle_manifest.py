"""Merkle dataset manifest by butterfly exchange.

Rows are leaves, sorted and numbered per class (language). Aligned blocks of ``fanout ** levels`` leaves are the
partitions of the tree: a task folds one block to its root. Then blocks swap roots round by round. In each round the
(at most ``fanout``) neighbouring subtrees of a parent form groups, one group for every block place of a subtree; a
group holds one block of each subtree, so every member sees all children, hashes the parent for itself and keeps
the children to its left and right as the next step of its proof. After the rounds of the classes and the rounds
between the classes every block knows the root and its whole upper proof, and nothing is sent down the tree.

A subtree with fewer blocks than its widest neighbour lets its blocks answer for several places, so that no place is left
without a partner. A group never has more than ``fanout`` messages; a class that holds a third of all rows is many
blocks like any other. The rounds are joins-free aggregates of one narrow row per block.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockwright.llm.common import LOWER, UPPER, table
from stockwright.sources.tables import stage

FANOUT = 8
LEVELS = 4  # of a block, which has FANOUT ** LEVELS leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SIDES = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def depth(n: int, fanout: int = FANOUT) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``_at``, the place in the group from 0 by ``order``, and ``_n``, the group's size.

    Rows are range-partitioned by group and order and written; each chunk then starts after the earlier ones. The
    table of counts has one row per chunk and group in it.
    """
    keys = [group, *order]
    placed = rows.withColumn("_salt", F.monotonically_increasing_id())  # equal rows are spread, too
    placed = placed.repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt").drop("_salt")
    placed = stage(placed.withColumn("_mark", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_chunk", F.shiftright("_mark", 33))
    counts = placed.groupBy(group, "_chunk").agg(F.min("_mark").alias("_first"), F.count("*").alias("_size"))
    whole = Window.partitionBy(group)
    before = F.sum("_size").over(whole.orderBy("_chunk")) - F.col("_size")
    counts = counts.select(
        group, "_chunk", (F.col("_first") - before).alias("_shift"), F.sum("_size").over(whole).alias("_n")
    )
    placed = placed.join(counts, [group, "_chunk"])
    return placed.withColumn("_at", F.col("_mark") - F.col("_shift")).drop("_mark", "_chunk", "_shift")


def parents(nodes: list[str], fanout: int) -> list[str]:
    return [digest("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]


def block_roots(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per block: class, block number, leaves of the class, root of the block."""

    def fold(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_at")
        nodes = rows.column("leaf").to_pylist()
        n = rows.column("_n")[0].as_py()
        for _ in range(min(levels, depth(n, fanout))):
            nodes = parents(nodes, fanout)
        return pa.table(
            {"group": rows.column("group").slice(0, 1), "block": rows.column("block").slice(0, 1),
             "n": pa.array([n], pa.int64()), "root": pa.array(nodes, pa.string())}
        )

    narrow = leaves.select("group", "block", "_at", "_n", "leaf")
    return narrow.groupBy("group", "block").applyInArrow(fold, "group string, block long, n long, root string")


def exchange(blocks: DataFrame, group: list[str], fanout: int) -> DataFrame:
    """One round: blocks of neighbouring subtrees swap roots, and each hashes the parent.

    ``blocks`` has ``node`` (number of the subtree), ``place`` (the block's place in it), ``width`` (blocks in it),
    ``widest`` (blocks in the widest subtree of the same parent), ``root`` (of the subtree), ``upper`` (proof so far) and
    ``own`` (what the block carries). The same columns but ``widest`` come back for the parents.
    """
    send = F.explode(F.sequence("place", F.col("widest") - 1, F.col("width"))).alias("slot")
    sent = blocks.withColumn("parent", F.expr(f"node div {fanout}")).select("*", send)
    mine = F.when(F.col("slot") == F.col("place"), F.struct("own", "upper"))
    heard = sent.groupBy(*group, "parent", "slot").agg(
        F.array_sort(F.collect_list(F.struct("node", "width", "root", mine.alias("mine")))).alias("heard")
    )
    roots = heard.withColumn("parent_root", F.sha2(F.array_join("heard.root", ""), 256)).withColumn(
        "parent_width", F.aggregate("heard.width", F.lit(0).cast("long"), lambda s, x: s + x)
    )
    each = roots.select("*", F.posexplode("heard").alias("k", "child")).where("child.mine IS NOT NULL")

    def around(field: str, start, length) -> Column:
        return F.slice(F.col(f"heard.{field}"), start, length)

    left, right = around("root", F.lit(1), F.col("k")), around("root", F.col("k") + 2, F.lit(fanout))
    offset = F.aggregate(around("width", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda s, x: s + x)
    step = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
    return each.select(
        *group,
        F.col("parent").alias("node"),
        (offset + F.col("slot")).alias("place"),
        F.col("parent_width").alias("width"),
        F.col("parent_root").alias("root"),
        F.concat("child.mine.upper", F.array(step)).alias("upper"),
        F.col("child.mine.own").alias("own"),
    )


def proofs_of_blocks(roots: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``group, block, n, subroot, root, upper`` of every block of ``block_roots``."""
    spark = roots.sparkSession
    size = fanout**levels
    n_blocks = F.ceil(F.col("n") / size).cast("long")
    roots = stage(roots.withColumn("blocks", n_blocks), "blocks")
    most = roots.agg(F.max("blocks")).first()[0]
    own = F.struct("group", "block", "n").alias("own")
    live = roots.select(
        "group", "blocks", own, F.col("block").alias("node"), F.lit(0).cast("long").alias("place"),
        F.lit(1).cast("long").alias("width"), "root", F.array().cast(_SIDES).alias("upper"),
    )
    # Rounds within the classes; classes of one subtree wait.
    span, waiting = 1, []
    while most is not None and span < most:
        waiting.append(live.where(F.col("blocks") <= span))
        live = live.where(F.col("blocks") > span)
        first = F.expr(f"node div {fanout}") * F.lit(fanout * span)
        live = live.withColumn("widest", F.least(F.lit(span), F.col("blocks") - first))
        live = exchange(live, ["group", "blocks"], fanout)
        span *= fanout
    for done in waiting:
        live = live.unionByName(done.select(live.columns))
    live = stage(live.withColumn("own", F.struct("own.*", F.col("root").alias("subroot"))), "subroots")

    # Rounds between the classes, in their order. The widths of a class's neighbours come from the counts alone.
    classes = numbered(
        live.groupBy("group").agg(F.first("blocks").alias("blocks")).withColumn("_one", F.lit(0)), "_one", ["group"]
    )
    classes = stage(classes.select("group", F.col("_at").alias("rank"), "blocks"), "classes")
    n_classes = classes.count()
    live = live.drop("blocks").join(classes.select("group", "rank"), "group").drop("group", "node")
    live = live.withColumnRenamed("rank", "node")
    span = 1
    while span < n_classes:
        child, parent = F.expr(f"rank div {span}"), F.expr(f"node div {fanout}")
        widths = classes.groupBy(child.alias("node")).agg(F.sum("blocks").alias("width"))
        widest = widths.groupBy(parent.alias("_parent")).agg(F.max("width").alias("widest"))
        live = live.withColumn("_parent", parent).join(widest, "_parent").drop("_parent")
        live = exchange(live, [], fanout)
        span *= fanout
    out = live.select("own.*", "root", "upper")
    return out if n_classes else spark.createDataFrame([], out.schema)


def proven(leaves: DataFrame, blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Every leaf with its subroot, root, proof digest, and the root folded from what was found."""
    schema = "row_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"

    def prove(rows: pa.Table, block: pa.Table) -> pa.Table:
        rows = rows.sort_by("_at")
        nodes, found = rows.column("leaf").to_pylist(), rows.column("found").to_pylist()
        above = block.to_pylist()[0]
        upper = [(s["left"], s["right"]) for s in above["upper"]]
        tree = [nodes]
        for _ in range(min(levels, depth(above["n"], fanout))):
            tree.append(parents(tree[-1], fanout))
        # Steps and proof texts of the nodes of a level, from the top down.
        steps = [tuple(upper)]
        texts = ["".join(left + right for left, right in upper)]
        for level in tree[-2::-1]:
            below, below_texts = [], []
            for i in range(len(level)):
                start = i - i % fanout
                left, right = "".join(level[start:i]), "".join(level[i + 1 : start + fanout])
                below.append(((left, right), *steps[i // fanout]))
                below_texts.append(left + right + texts[i // fanout])
            steps, texts = below, below_texts
        folded = []
        for node, path in zip(found, steps):
            for left, right in path:
                node = digest(left + node + right)
            folded.append(node)
        n = len(nodes)
        return pa.table(
            {
                "row_id": rows.column("row_id"),
                "leaf": rows.column("leaf"),
                "subroot": pa.array([above["subroot"]] * n, pa.string()),
                "root": pa.array([above["root"]] * n, pa.string()),
                "proof_sha256": pa.array(list(map(digest, texts)), pa.string()),
                "folded_root": pa.array(folded, pa.string()),
            }
        )

    narrow = leaves.select("group", "block", "_at", "row_id", "leaf", "found")
    return narrow.groupBy("group", "block").cogroup(blocks.groupBy("group", "block")).applyInArrow(prove, schema)


def manifest(
    rows: DataFrame, group: Column, row_id: Column, own: Column, found: Column, fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """Proofs of all rows: ``row_id, leaf, subroot, root, proof_sha256, folded_root``.

    ``group`` is the class (null first), ``row_id`` the order in it (null first, then by leaf), ``own`` the leaf digest as
    recorded and ``found`` the digest of what is there now. ``folded_root`` differs from ``root`` where they differ.
    """
    named = rows.select(
        # Null before all texts, and texts in the order of their bytes.
        F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("group"),
        row_id.cast("long").alias("row_id"),
        own.alias("leaf"),
        found.alias("found"),
    )
    placed = numbered(named, "group", ["row_id", "leaf"]).withColumn("block", F.expr(f"_at div {fanout**levels}"))
    blocks = stage(proofs_of_blocks(block_roots(placed, fanout, levels), fanout, levels), "proofs")
    return proven(placed, blocks, fanout, levels)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document, the texts of every third id (by checksum) lower-cased before the check.

    Nulls are ``-`` in a leaf; a null language is the first class, a null id the first of its class and never tampered
    with; empty texts are ``0:``. Repeated rows are leaves each, rows of one id lie by their leaves. No documents give
    no rows. Columns other than the five of a leaf do not matter.
    """
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    own = leaf([F.col(c) for c in FIELDS])
    lowered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = manifest(docs, F.col("lang"), F.col("doc_id"), own, F.when(tampered, leaf(lowered)).otherwise(own))
    return out.withColumnRenamed("row_id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))
