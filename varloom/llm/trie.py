"""The trie of conversation prefixes, and totals of its subtrees by parallel tree contraction.

A prefix is known by 128 bits: the exclusive or of one hash of each of its turns and their places.  Such values are
combined in any grouping, so that a conversation of any length is cut into blocks, and only one value a block is
carried on.  A trie node is a distinct prefix.

Totals are found by contraction.  A round rakes all leaves into their parents and then compresses chains: a node with
one child is taken out if its hash of the round exceeds those of its parent and its child, its parent takes over what
it held and its child.  Both leave fewer nodes by a constant factor, so that the rounds grow with the logarithm of the
tree, however deep it is.  Going back through the rounds, a raked node's total is what it held, and that of a node
that was taken out is what it held and the total of its child.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import scratch_dir
from .order import in_order, part
from .tables import kept

#: First turns that conversations share with another one, at most.
MOST_SHARED = 8
#: Turns of a conversation that are numbered in one task.
BLOCK = 1 << 16
#: Ids that end at one node and are joined to one text before they are hashed.
IDS = 4096
#: Characters of a text that order turns of equal number and role, before its digest does.
TIE = 100

NODE = ["k1", "k2"]
PARENT = ["p1", "p2"]
CHILD = ["c1", "c2"]


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn1, turn2, bytes``: the turns numbered from 1, their content as 128 bits."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.left(text, F.lit(TIE)).alias("begin"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("begin"), F.col("digest")]
    ordered = in_order(rows, by, "turns").withColumn("part", part())
    # A conversation that goes on in a further part is numbered on from there; each part has one such at most.
    runs = ordered.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = runs.withColumn("offset", F.sum("n").over(earlier)).where("offset IS NOT NULL").drop("n")
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("at"))
    numbered = ordered.withColumn("pos", local.cast("long")).join(offset, ["conv_id", "part"], "left")
    return numbered.select(
        "conv_id",
        (F.col("pos") + F.coalesce("offset", F.lit(0))).alias("pos"),
        *[F.xxhash64(F.lit(i), "role", "digest").alias(f"turn{i}") for i in (1, 2)],
        "bytes",
    )


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the one that it shares them with."""
    return F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)


def _paths(conversations: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation: ``conv_id, depth, k1, k2, p1, p2, bytes, last``."""
    turns = kept(_turns(conversations), "turns")
    lengths = kept(turns.groupBy("conv_id").agg(F.count("*").alias("length")), "lengths")
    owner = F.col("conv_id") - F.col("conv_id") % 5
    convs = lengths.select("conv_id", "length", owner.alias("owner"), shared_turns(F.col("conv_id")).alias("h"))
    given = lengths.select(F.col("conv_id").alias("owner"), F.col("length").alias("owner_length"))
    taken = F.least("h", F.coalesce("owner_length", F.lit(0)))
    convs = convs.join(given, "owner", "left").select("conv_id", "owner", "h", taken.alias("taken"), "length")
    convs = kept(convs.withColumn("rebuilt", F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))), "convs")

    first = turns.where(F.col("pos") <= MOST_SHARED).withColumnRenamed("conv_id", "owner")
    heads = convs.select("conv_id", "owner", "taken", "rebuilt").join(first, "owner").where("pos <= taken")
    own = turns.where(F.col("pos") > shared_turns(F.col("conv_id")))
    own = own.join(convs.select("conv_id", "h", "taken", "rebuilt"), "conv_id").withColumn("pos", F.expr("pos - h + taken"))
    columns = ["conv_id", "pos", "turn1", "turn2", "bytes", "rebuilt"]
    steps = heads.select(columns).unionByName(own.select(columns)).select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.floor((F.col("pos") - 1) / BLOCK).alias("block"),
        *[F.xxhash64("pos", f"turn{i}").alias(f"x{i}") for i in (1, 2)],
        "bytes",
        (F.col("pos") == F.col("rebuilt")).alias("last"),
    )
    steps = kept(steps, "steps")
    # What the blocks before combine to; only conversations of more than one block have such a row.
    blocks = steps.groupBy("conv_id", "block").agg(*[F.bit_xor(f"x{i}").alias(f"x{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select("conv_id", "block", *[F.bit_xor(f"x{i}").over(earlier).alias(f"c{i}") for i in (1, 2)])
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    paths = steps.withColumns({f"u{i}": F.bit_xor(f"x{i}").over(upto) for i in (1, 2)})
    paths = paths.join(carry.where("block > 0"), ["conv_id", "block"], "left")
    key = {i: F.col(f"u{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in (1, 2)}
    paths = paths.select(
        "conv_id",
        "depth",
        *[key[i].alias(f"k{i}") for i in (1, 2)],
        *[key[i].bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (1, 2)],
        "bytes",
        "last",
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select(
        "conv_id",
        zero.alias("depth"),
        *[zero.alias(c) for c in NODE],
        *[none.alias(c) for c in PARENT],
        zero.alias("bytes"),
        (F.col("rebuilt") == 0).alias("last"),
    )
    return kept(paths.unionByName(root), "paths")


def _hash_ids(batches):
    """Tasks: the digest of each node's texts of ids in their order; a node's texts come one after the other."""
    node, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [*[pa.array([k], pa.int64()) for k in node], pa.array([digest.hexdigest()])], [*NODE, "ends_sha256"]
        )

    for batch in batches:
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if (k1, k2) != node:
                if node is not None:
                    yield row()
                node, digest = (k1, k2), hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
    if node is not None:
        yield row()


def _ends(paths: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` of nodes at which conversations end.

    Ids are ordered by ranges over all nodes and joined to texts of ``IDS`` ids, so that the last step, one digest
    after the other, reads only texts.
    """
    ids = paths.where("last").select(*NODE, "conv_id")
    ordered = in_order(ids, [F.col(c) for c in (*NODE, "conv_id")], "ends")
    portion = F.floor(F.col("at") / IDS).alias("portion")
    texts = ordered.groupBy(*NODE, portion).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    dealt = texts.repartition(*NODE).sortWithinPartitions(*NODE, "portion")
    return dealt.select(*NODE, "ids").mapInArrow(_hash_ids, "k1 long, k2 long, ends_sha256 string")


def _priority(round_number: int, columns: list[str]) -> Column:
    return F.xxhash64(F.lit(round_number), *columns)


def _up(columns: list[str]) -> list[Column]:
    return [F.col(c).alias(k) for c, k in zip(columns, NODE)]


def _rounds(nodes: DataFrame, values: list[str]) -> list[DataFrame]:
    """Contract the tree to its root; each round as a stored table of what it did with the nodes that it found.

    ``nodes``: ``k1, k2, p1, p2, leaf`` and the values; the root has no parent.  ``fate`` of a round's rows tells
    whether a node was ``raked`` or ``compressed`` or ``stays``, which in the end only the root does.
    """
    live, done = nodes, []
    while True:
        below = live.where("p1 IS NOT NULL").groupBy(*_up(PARENT)).agg(
            *[F.sum(F.when(F.col("leaf"), F.col(v)).otherwise(0)).alias(f"more_{v}") for v in values],
            F.count_if(~F.col("leaf")).alias("children"),
            *[F.min(F.when(~F.col("leaf"), F.col(k))).alias(c) for k, c in zip(NODE, CHILD)],
        )
        mine, child, parent = (_priority(len(done), c) for c in (NODE, CHILD, PARENT))
        fate = (
            F.when(F.col("p1").isNull(), "stays")
            .when(F.col("leaf"), "raked")
            .when((F.col("children") == 1) & (mine > child) & (mine > parent), "compressed")
            .otherwise("stays")
        )
        done.append(kept(
            live.join(below, NODE, "left").select(
                *[*NODE, *PARENT, *CHILD],
                *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values],
                (F.coalesce("children", F.lit(0)) == 0).alias("leaf"),
                fate.alias("fate"),
            ),
            "contracted",
        ))
        left, out = done[-1].where("fate = 'stays'"), done[-1].where("fate = 'compressed'")
        if left.limit(2).count() == 1:
            return done
        # The parent takes over what a compressed node held, its child the parent.
        none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
        unknown = F.lit(None).cast("boolean").alias("leaf")
        stay = left.select(*[*NODE, *PARENT], *[none.alias(f"new_{p}") for p in PARENT], *values, "leaf")
        no_parent = [none.alias(p) for p in PARENT]
        to_parent = out.select(*_up(PARENT), *no_parent, *[none.alias(f"new_{p}") for p in PARENT], *values, unknown)
        to_child = out.select(
            *_up(CHILD), *no_parent, *[F.col(p).alias(f"new_{p}") for p in PARENT], *[zero.alias(v) for v in values], unknown
        )
        live = stay.unionByName(to_parent).unionByName(to_child).groupBy(*NODE).agg(
            *[F.coalesce(F.max(f"new_{p}"), F.max(p)).alias(p) for p in PARENT],
            *[F.sum(v).alias(v) for v in values],
            F.max("leaf").alias("leaf"),
        )


def subtree_totals(spark: SparkSession, nodes: DataFrame, values: list[str]) -> DataFrame:
    """``k1, k2`` and for each value its sum over the subtree of every node of one tree, itself included.

    ``nodes``: ``k1, k2``, the parent's ``p1, p2`` (null at the root), whether it is a ``leaf``, and the values.
    """
    done = _rounds(nodes, values)
    folder = scratch_dir(spark, "totals")
    paths = [f"{folder}/root"]
    done[-1].where("fate = 'stays'").select(*NODE, *values).write.parquet(paths[0])
    schema = spark.read.parquet(paths[0]).schema
    for number, found in reversed(list(enumerate(done))):
        known = spark.read.schema(schema).parquet(*paths)
        below = known.select(*[F.col(k).alias(c) for k, c in zip(NODE, CHILD)], *[F.col(v).alias(f"below_{v}") for v in values])
        expanded = found.where("fate = 'compressed'").join(below, CHILD)
        raked = found.where("fate = 'raked'").select(*NODE, *values)
        paths.append(f"{folder}/{number}")
        raked.unionByName(
            expanded.select(*NODE, *[(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values])
        ).write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversations are rebuilt first: the first turns of the conversation whose id is the next lower multiple of five,
    as many as ``shared_turns`` says and it has, then their own turns after as many.  ``conv_id`` is the smallest
    member of a node, ``n_leaves`` and ``saved_tokens`` are totals of its subtree.

    Rows without a conv_id belong to no conversation.  A null role or text is an empty one.  Turns of equal number
    are ordered by role, the first ``TIE`` characters of their text and its digest; rows that repeat are turns of
    their own.  No rows give no nodes, not even a root.  Other columns are ignored.
    """
    spark = conversations.sparkSession
    paths = _paths(conversations)
    nodes = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        *[F.first(p).alias(p) for p in PARENT],
        F.count("*").alias("n_convs"),
        F.first("bytes").alias("bytes"),
    )
    nodes = kept(nodes, "nodes")
    kids = nodes.where("p1 IS NOT NULL").groupBy(*_up(PARENT)).agg(F.count("*").alias("n_children"))
    above = nodes.select(*[F.col(k).alias(p) for k, p in zip(NODE, PARENT)], F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = kept(nodes.join(above, PARENT, "left"), "nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children"]
    if not nodes.limit(1).count():
        totals = nodes.select(*NODE, F.col("depth").alias("n_leaves"), F.col("depth").alias("saved_tokens"))
    else:
        leaf = F.col("n_children") == 0
        saved = (F.col("n_convs") - 1) * F.col("bytes")
        weights = nodes.select(
            *[*NODE, *PARENT], leaf.cast("long").alias("n_leaves"), saved.alias("saved_tokens"), leaf.alias("leaf")
        )
        totals = subtree_totals(spark, weights, ["n_leaves", "saved_tokens"])
    ends = kept(_ends(paths), "ends")
    none = F.sha2(F.lit(""), 256)
    return nodes.join(totals, NODE).join(ends, NODE, "left").select(
        *columns, "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
