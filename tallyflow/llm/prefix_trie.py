"""Prefix trie of conversations; totals of all subtrees by parallel tree contraction."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.tables import staged
from tallyflow.operators.ordering import numbered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Turns whose digests are chained in one window, and bits of the ids that meet in one list.
CHUNK, ID_BITS = 64, 12
#: Expanded rounds between two written tables.
STAGED_ROUNDS = 4


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, pos, role, text): positions from 1 by turn, null first; ties by role, then by the text's digest.

    Null roles and texts become empty. Rows without conv_id belong to no conversation and are left out.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # digests order ties, so that no text is a sort key
    placed = numbered(rows.withColumn("_d", F.sha2("text", 256)), ["conv_id", "turn", "role", "_d"], ["conv_id"], out="pos")
    return placed.select("conv_id", "turn", (F.col("pos") + 1).alias("pos"), "role", "text")


def prefix_keys(items: DataFrame) -> DataFrame:
    """(conv_id, pos, digest) rows with ``key``, which is equal for equal sequences of items up to ``pos``.

    Positions are cut into chunks of CHUNK. Inside a chunk the key is the SHA-256 digest of the digests so
    far; whole chunks are items of a shorter sequence, whose keys come the same way. So no window holds more than
    CHUNK rows, however long a conversation is. Keys are equal only for equal positions or by a SHA-256 collision.
    """
    chunk = F.floor((F.col("pos") - 1) / CHUNK).cast("long")
    inside = Window.partitionBy("conv_id", "_chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = items.withColumn("_chunk", chunk).withColumn("_own", F.sha2(F.array_join(F.collect_list("digest").over(inside), ""), 256))
    if not (items.agg(F.max("pos")).first()[0] or 0) > CHUNK:
        return own.withColumn("key", F.col("_own")).drop("_chunk", "_own")
    own = staged(own)
    whole = own.where(F.col("pos") % CHUNK == 0).select("conv_id", (F.col("_chunk") + 1).alias("pos"), F.col("_own").alias("digest"))
    before = prefix_keys(whole).select("conv_id", F.col("pos").alias("_chunk"), F.col("key").alias("_before"))
    joined = own.join(before, ["conv_id", "_chunk"], "left")
    key = F.when(F.col("_before").isNull(), F.col("_own")).otherwise(F.sha2(F.concat("_before", "_own"), 256))
    return joined.withColumn("key", key).drop("_chunk", "_own", "_before")


def trie_nodes(conversations: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_bytes, key) of all nodes but the root; (key, conv_id) of the
    node in which each conversation with turns ends. Both are written tables."""
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    items = turns.select("conv_id", "pos", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    places = staged(prefix_keys(items).select("conv_id", F.col("pos").alias("depth"), "key", "n_bytes"))
    nodes = places.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes")
    )
    nodes = staged(nodes)
    # a node's parent holds the turn before in the same conversation
    above = places.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"))
    linked = staged(nodes.join(above, ["conv_id", "depth"], "left"))
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    smallest = conversations.agg(F.min("conv_id").alias("c")).scalar()
    linked = linked.join(parents, "parent_key", "left")
    linked = staged(linked.withColumn("parent_conv_id", F.when(F.col("depth") == 1, smallest).otherwise(F.col("parent_conv_id"))))
    last = places.groupBy("conv_id").agg(F.max_by("key", "depth").alias("key"))
    return linked.drop("parent_key"), staged(last.select("key", "conv_id"))


def id_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the decimal conv_ids of each key, ascending, joined by commas.

    Ids are first joined to lists of at most 2 ** ID_BITS, by their upper bits, so that a key of a third
    of all conversations is spread; the lists of a key then pass in order through one digest, which holds no list.
    """
    lists = ends.groupBy("key", F.shiftright("conv_id", ID_BITS).alias("part")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    lists = lists.select("key", "part", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, found = [], []
            for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if own != key:
                    if state is not None:
                        keys.append(key)
                        found.append(state.hexdigest())
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, pa.string())], ["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    return lists.repartition("key").sortWithinPartitions("key", "part").mapInArrow(digests, "key string, ends_sha256 string")


def subtree_totals(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """(c, d, the sums): the totals over each node's subtree, itself included.

    ``nodes`` holds (c, d, pc, pd, kids, the sums): a node, its parent (null at the root), its number of children,
    its own values; d grows from parents to children. A round has two steps:

    - rake: leaves give their totals to their parents and go;
    - compress: a node with one child hands what it has to the edge above that child and goes, if the
      round's bit of its d is 1 and that of its parent's is 0. So of two neighbours one goes at most, chains
      of consecutive d are halved in each round, and the bits of all d passed, any chain has lost a node.

    A node's children are known by their number and the exclusive or of their names, which is the child's name
    where there is one. So each step is one aggregation of messages by the node that they go to, with map-side combine,
    and one join of unique keys: a parent with a third of all nodes as children is no hot key.

    When only the root is left, the rounds are undone from the last: a compressed node's total is what it
    had, and its edge's, and the total of the child that it was joined to. Each round is a written table.
    """
    state = [*(f"w_{s}" for s in sums), *(f"e_{s}" for s in sums)]
    zero = F.lit(0).cast("long")
    names = nodes.where("pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
        F.bit_xor("c").alias("xc"), F.bit_xor("d").alias("xd")
    )
    start = nodes.join(names, ["c", "d"], "left").select(
        "c", "d", "pc", "pd", "kids", *[F.coalesce(x, zero).alias(x) for x in ("xc", "xd")],
        *[F.col(s).cast("long").alias(f"w_{s}") for s in sums], *[zero.alias(f"e_{s}") for s in sums],
    )
    active = staged(start)
    deepest = int(active.agg(F.max("d")).first()[0] or 0)
    bits = max(1, deepest.bit_length())
    rounds: list[tuple[DataFrame, DataFrame | None]] = []  # the table before each rake, with what the compress before it removed
    removed = None
    while True:
        rounds.append((active, removed))
        leaf = (F.col("kids") == 0) & F.col("pc").isNotNull()
        if active.where(F.col("pc").isNotNull()).isEmpty():
            break
        if len(rounds) > deepest:  # every rake takes a level of leaves at least
            raise ValueError("the nodes are no tree: a parent is missing")
        given = active.where(leaf).groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
            F.count(F.lit(1)).alias("m_kids"), F.bit_xor("c").alias("m_xc"), F.bit_xor("d").alias("m_xd"),
            *[F.sum(F.col(f"w_{s}") + F.col(f"e_{s}")).alias(f"m_{s}") for s in sums],
        )
        raked = staged(
            active.where(~leaf).join(given, ["c", "d"], "left").select(
                "c", "d", "pc", "pd", (F.col("kids") - F.coalesce("m_kids", zero)).alias("kids"),
                *[F.col(x).bitwiseXOR(F.coalesce(f"m_{x}", zero)).alias(x) for x in ("xc", "xd")],
                *[(F.col(f"w_{s}") + F.coalesce(f"m_{s}", zero)).alias(f"w_{s}") for s in sums], *[f"e_{s}" for s in sums],
            )
        )
        turn = (len(rounds) - 1) % bits
        bit = lambda x: F.shiftright(x, turn).bitwiseAND(1)  # noqa: B023, E731
        goes = F.col("pc").isNotNull() & (F.col("kids") == 1) & (bit("d") == 1) & (bit("pd") == 0)
        gone = raked.where(F.coalesce(goes, F.lit(False)))
        blank = F.lit(None).cast("long")
        to_child = gone.select(
            F.col("xc").alias("c"), F.col("xd").alias("d"), F.col("pc").alias("m_pc"), F.col("pd").alias("m_pd"), zero.alias("m_xc"), zero.alias("m_xd"),
            *[F.col(f"w_{s}").alias(f"m_w_{s}") for s in sums], *[F.col(f"e_{s}").alias(f"m_e_{s}") for s in sums],
        )
        to_parent = gone.select(
            F.col("pc").alias("c"), F.col("pd").alias("d"), blank.alias("m_pc"), blank.alias("m_pd"),
            F.col("c").bitwiseXOR(F.col("xc")).alias("m_xc"), F.col("d").bitwiseXOR(F.col("xd")).alias("m_xd"),
            *[blank.alias(f"m_{s}") for s in state],
        )
        messages = to_child.unionAll(to_parent).groupBy("c", "d").agg(
            *[F.max(x).alias(x) for x in ("m_pc", "m_pd")], *[F.bit_xor(x).alias(x) for x in ("m_xc", "m_xd")],
            *[F.sum(f"m_{x}").alias(f"m_{x}") for x in state],
        )
        spliced = F.col("m_pc").isNotNull()
        after = staged(
            raked.where(~F.coalesce(goes, F.lit(False))).join(messages, ["c", "d"], "left").select(
                "c", "d", *[F.when(spliced, F.col(f"m_{x}")).otherwise(F.col(x)).alias(x) for x in ("pc", "pd")], "kids",
                *[F.col(x).bitwiseXOR(F.coalesce(f"m_{x}", zero)).alias(x) for x in ("xc", "xd")], *[f"w_{s}" for s in sums],
                *[(F.col(f"e_{s}") + F.coalesce(f"m_w_{s}", zero) + F.coalesce(f"m_e_{s}", zero)).alias(f"e_{s}") for s in sums],
                *[F.when(spliced, F.col(x)).alias(f"g_{x}") for x in ("pc", "pd")],
                *[F.when(spliced, F.col(f"m_w_{s}") + F.col(f"e_{s}")).alias(f"g_{s}") for s in sums],
            )
        )
        # where a node was taken out above (c, d): its name, and its total without that of (c, d)
        removed = after.where("g_pc is not null").select("c", "d", "g_pc", "g_pd", *[f"g_{s}" for s in sums])
        active = after.drop("g_pc", "g_pd", *[f"g_{s}" for s in sums])
    totals = None
    for n, (table, taken) in enumerate(reversed(rounds)):
        own = table.where("kids = 0").select("c", "d", *[F.col(f"w_{s}").alias(s) for s in sums])
        totals = own if totals is None else totals.unionAll(own)
        if taken is not None:
            joined = totals.join(taken, ["c", "d"], "left")
            itself = F.struct("c", "d", *sums)
            other = F.struct(
                F.col("g_pc").alias("c"), F.col("g_pd").alias("d"), *[(F.col(s) + F.col(f"g_{s}")).alias(s) for s in sums]
            )
            both = F.when(F.col("g_pc").isNull(), F.array(itself)).otherwise(F.array(itself, other))
            totals = joined.select(F.explode(both).alias("_t")).select("_t.*")
        if n % STAGED_ROUNDS == STAGED_ROUNDS - 1:
            totals = staged(totals)
    return totals


def prefix_trie(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each different sequence of first turns of the conversations, the empty one included.

    ``conversations`` holds the distinct conv_ids, also those without turn; ``turns`` (conv_id, pos, role, text) with
    positions from 1 without gap, role and text not null. A node's members are the conversations that begin with it.

    Columns: conv_id, the smallest member, which with depth names the node; parent_conv_id, likewise (null at
    the root); n_convs, members; n_children; n_leaves, nodes without child in the subtree; saved_tokens, over
    the subtree, (n_convs - 1) times the bytes of a node's last text; ends_sha256, see ``id_digests``, of
    the members that end here. Without any conversation there is no node.
    """
    nodes, last = trie_nodes(conversations, turns)
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.lit(0).cast("long").alias("n_bytes"), F.lit("").alias("key"),
    )
    every = nodes.select(*root.columns).unionAll(root)
    kids = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    every = every.join(kids, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    every = staged(every)
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    parent_depth = F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1)
    totals = subtree_totals(
        every.select(
            F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"), parent_depth.alias("pd"),
            F.col("n_children").alias("kids"), (F.col("n_children") == 0).cast("long").alias("n_leaves"), saved.alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    turnless = conversations.join(last.select("conv_id"), "conv_id", "left_anti").select(F.lit("").alias("key"), "conv_id")
    ends = id_digests(last.unionAll(turnless))
    joined = every.join(totals.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), "n_leaves", "saved_tokens"), ["conv_id", "depth"])
    joined = joined.join(ends, "key", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
