"""Prefix trie of conversations by truncation peeling.

*Keys.*  A turn is a 128-bit digest of role and text, a node the chained digest of its turns from the root
on, so a prefix has one key wherever it occurs; a conversation carries the keys of its prefixes and
no text.

*Peeling.*  Equal conversations are one row with their number.  From the greatest depth down, each round takes the
rows of one depth - those that end there, and the nodes that were found below and lost their last turn - and groups them by
key (partial aggregates first, so a node that a third of all conversations share is no task's group): a
group is a node, and its members, children, leaves and saved bytes are sums over the group.  Then the
nodes lose their last turn and meet the conversations that end one turn higher.

*Tails.*  Below the deepest turn that a conversation shares with a different one nothing can meet it, so those
turns are peeled in one go where the row is; a count of each prefix key (one shuffle of keys) tells how far.  So
there are as many rounds as the deepest shared prefix has turns, however long conversations are.

*Ends.*  The ids of the conversations that end at a node are joined in blocks of 4,096 ids and their digest runs over
the node's blocks in order, so no list of ids is held whole.

Nothing but the greatest shared depth comes to the driver.  A conversation's keys (16 bytes a turn) are one row.

Defined results: rows with a null id belong to no conversation; null role or text is empty; turns are ordered by turn
(null first), ties by role, then text; repeated rows are turns of their own; conversations without turns are members of the root
only; other columns are ignored; no conversations give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, null_as_empty, pick, settled, small_batches, staged, tuning

ROOT = b""
BLOCK = 4096  # ids of a block
MODULUS, GROUP = 9, 5  # of the rebuilt conversations: turns taken over, ids that share a beginning


def number_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, pos`` (from 1), ``digest`` of role and text, ``size`` (UTF-8 bytes of the text)."""
    src = pick(rows, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).where("conv_id is not null")
    src = src.withColumns({"role": null_as_empty(F.col("role")), "text": null_as_empty(F.col("text"))})
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.substring(F.unhex(F.sha2(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), "utf-8"), 256)), 1, 16)
    return src.select("conv_id", F.row_number().over(order).alias("pos"), digest.alias("digest"), F.octet_length("text").cast("bigint").alias("size"))


def taken_over(conv_id: Column) -> Column:
    """How many turns a conversation takes over: the id's unsigned crc32, modulo 9."""
    return (F.crc32(F.encode(conv_id.cast("string"), "utf-8")) % MODULUS).cast("int")


def rebuild(turns: DataFrame) -> DataFrame:
    """The rebuilt conversations of ``number_turns`` rows (staged): the first turns of the group's first conversation, then
    what the own turns have after as many.  One row per turn, and one with null ``pos`` for each conversation."""
    convs = turns.select("conv_id").distinct().withColumn("taken", taken_over(F.col("conv_id")))
    own = turns.where(F.col("pos") > taken_over(F.col("conv_id")))
    first = turns.where((F.col("pos") < MODULUS) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "first_id")
    lead = (convs.join(first, convs["conv_id"] - convs["conv_id"] % GROUP == first["first_id"]).where("pos <= taken")
            .select("conv_id", "pos", "digest", "size"))
    marks = convs.selectExpr("conv_id", "CAST(null AS INT) AS pos", "CAST(null AS BINARY) AS digest", "CAST(null AS BIGINT) AS size")
    return own.unionByName(lead).unionByName(marks)


def as_numbered(turns: DataFrame) -> DataFrame:
    """As ``rebuild``, with every conversation as it is."""
    marks = turns.select("conv_id").distinct().selectExpr("conv_id", "CAST(null AS INT) AS pos", "CAST(null AS BINARY) AS digest", "CAST(null AS BIGINT) AS size")
    return turns.unionByName(marks)


def prefix_chains(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``keys`` of its prefixes (depth 1 on) and ``rest``, for each depth from 1 on
    the text bytes from that turn to the end, and a last 0."""
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "digest", "size")))).alias("turns"))
    src = lists.select("conv_id", F.transform("turns", lambda t: t["digest"]).alias("digests"), F.transform("turns", lambda t: t["size"]).alias("sizes"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, rests = [], []
            for digests, sizes in zip(batch.column("digests").to_pylist(), batch.column("sizes").to_pylist()):
                key, chain = ROOT, []
                for digest in digests:
                    key = hashlib.sha256(key + digest).digest()[:16]
                    chain.append(key)
                rest = [0]
                for n in reversed(sizes):
                    rest.append(rest[-1] + n)
                keys.append(chain)
                rests.append(rest[::-1])
            return pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(keys, pa.list_(pa.binary())), pa.array(rests, pa.list_(pa.int64()))],
                                              ["conv_id", "keys", "rest"])
        return step
    return map_batches(src, make, f"conv_id {src.schema['conv_id'].dataType.simpleString()}, keys array<binary>, rest array<bigint>")


def key_at(depth: Column) -> Column:
    """The key of a row's prefix of this depth."""
    return F.when(depth < 1, F.lit(ROOT)).otherwise(F.try_element_at("keys", F.greatest(depth, F.lit(1))))


def last_size(depth: Column) -> Column:
    """Text bytes of the turn at this depth; the root has none."""
    return F.when(depth < 1, F.lit(0).cast("bigint")).otherwise(
        F.try_element_at("rest", F.greatest(depth, F.lit(1))) - F.try_element_at("rest", depth + 1))


def distinct_conversations(chains: DataFrame) -> DataFrame:
    """One row per distinct conversation: ``last`` (its key), ``n`` of them, ``first`` (the smallest id), ``keys, rest, depth``."""
    return (chains.withColumn("depth", F.size("keys")).withColumn("last", key_at(F.col("depth"))).groupBy("last")
            .agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), F.first("keys").alias("keys"), F.first("rest").alias("rest"), F.first("depth").alias("depth")))


def find_tails(distinct: DataFrame) -> DataFrame:
    """``distinct`` with ``alone``: the smallest depth whose prefix no different conversation has (depth + 1: none)."""
    prefixes = distinct.select("last", F.posexplode("keys").alias("at", "key"))
    alone = (prefixes.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("at", "last")).alias("one")).where("n = 1")
             .groupBy(F.col("one.last").alias("last")).agg((F.min("one.at") + 1).alias("alone")))
    return distinct.join(alone, "last", "left").withColumn("alone", F.coalesce("alone", F.col("depth") + 1))


def tail_nodes(rows: DataFrame) -> DataFrame:
    """The nodes of all tails; the topmost one's parent is shared, its id isn't known here."""
    depth = F.col("d")
    return (rows.where("alone <= depth").withColumn("d", F.explode(F.sequence("alone", "depth")))
            .select(key_at(depth).alias("key"), depth.cast("bigint").alias("depth"), F.col("first").alias("conv_id"), key_at(depth - 1).alias("parent"),
                    F.when(depth > F.col("alone"), F.col("first")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
                    (depth < F.col("depth")).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
                    ((F.col("n") - 1) * F.try_element_at("rest", depth)).alias("saved_tokens")))


def peeled_rows(rows: DataFrame) -> DataFrame:
    """What a conversation brings to the round of depth ``at``: its tail as a child, or, without one, itself."""
    has = F.col("alone") <= F.col("depth")
    at = F.col("alone") - 1
    return rows.select(at.alias("at"), F.slice("keys", F.lit(1), at).alias("keys"), F.slice("rest", F.lit(1), at + 1).alias("rest"), "n", "first",
                       has.cast("bigint").alias("children"), has.cast("bigint").alias("leaves"),
                       F.when(has, (F.col("n") - 1) * F.try_element_at("rest", F.col("alone"))).otherwise(0).cast("bigint").alias("saved"))


def peel(ended: DataFrame, depth: int) -> list[DataFrame]:
    """The nodes of depths ``depth`` to 0, a staged table each, from ``peeled_rows``."""
    levels: list[DataFrame] = []
    columns = ["keys", "rest", "n", "first", "children", "leaves", "saved"]
    for d in range(depth, -1, -1):
        here = ended.where(F.col("at") == d).select(columns)
        if levels:
            below = levels[-1]
            here = here.unionByName(below.select(
                F.slice("keys", 1, d).alias("keys"), F.slice("rest", 1, d + 1).alias("rest"), F.col("n_convs").alias("n"), F.col("conv_id").alias("first"),
                F.lit(1).cast("bigint").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
        at = F.lit(d)
        groups = here.withColumn("key", key_at(at)).groupBy("key").agg(
            *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.min("first").alias("first"), F.first("keys").alias("keys"), F.first("rest").alias("rest"))
        levels.append(staged(groups.select(
            "key", F.lit(d).cast("bigint").alias("depth"), F.col("first").alias("conv_id"), key_at(at - 1).alias("parent"), F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"), F.greatest("leaves", F.lit(1)).alias("n_leaves"),
            (F.col("saved") + (F.col("n") - 1) * last_size(at)).alias("saved_tokens"), "keys", "rest"), "trie-level"))
    return levels


def end_digests(chains: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of every node at which conversations end."""
    ids = chains.select(key_at(F.size("keys")).alias("key"), "conv_id")
    blocks = ids.groupBy("key", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    dealt = blocks.repartition(tuning(chains.sparkSession), "key").sortWithinPartitions("key", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            keys, out = [], []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        out.append(digest.hexdigest())
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["key", "ends_sha256"])
    small_batches(chains.sparkSession)
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def trie_of(turns: DataFrame) -> DataFrame:
    """The nodes, as a plan over tables that it stages."""
    chains = staged(prefix_chains(turns), "chains")
    found = staged(find_tails(distinct_conversations(chains)), "conversations")
    deepest = found.agg(F.max(F.col("alone") - 1)).first()[0]
    levels = peel(staged(peeled_rows(found), "ended"), deepest if deepest is not None else 0)
    tails = tail_nodes(found)
    shared = reduce(DataFrame.unionByName, [x.drop("keys", "rest") for x in levels])
    nodes = shared.withColumn("parent_conv_id", F.lit(None).cast(tails.schema["parent_conv_id"].dataType)).unionByName(tails)
    # A root has no parent and most tail nodes know theirs; the others look it up (a hot parent's children are split by Spark).
    unknown = nodes.where("parent_conv_id is null and depth > 0").drop("parent_conv_id")
    parents = shared.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.where("parent_conv_id is not null or depth = 0").unionByName(unknown.join(parents, "parent"))
    return whole.join(end_digests(chains), "key", "left").select(
        *[F.col(c).cast("bigint").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """The nodes of the trie over ``conv_id, turn, role, text`` rows: ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``."""
    return settled(rows.sparkSession, lambda: trie_of(as_numbered(staged(number_turns(rows), "turns"))), "trie")


def rebuilt_trie(rows: DataFrame) -> DataFrame:
    """``prefix_trie`` of the rebuilt conversations."""
    return settled(rows.sparkSession, lambda: trie_of(rebuild(staged(number_turns(rows), "turns"))), "trie")
