"""Conversations as a trie of their prefixes of turns: who shares what, and what sharing saves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.contraction import subtree_totals
from threadloom.operators.skew import skew_join
from threadloom.session import cut, discard

# Ids that are joined to one piece of text before a node's ids are hashed.
IDS_AT_ONCE = 4096
# A tree of every GROUP conversations: each begins with up to MOST_SHARED turns of the first of them.
GROUP, MOST_SHARED = 5, 8
NODE = ["depth", "_p1", "_p2"]


def _laid_out(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` sorted into ranges by conv_id and ``order``, with the range's number ``_block``: one conversation may span many."""
    return cut(rows.repartitionByRange("conv_id", *order).withColumn("_block", F.spark_partition_id()))


def _blocks(laid: DataFrame, *sums: Column) -> DataFrame:
    """Per conversation and block the named aggregates, with the rows of all earlier blocks (``_before``) and of all (``_all``)."""
    whole = Window.partitionBy("conv_id")
    counts = laid.groupBy("conv_id", "_block").agg(F.count(F.lit(1)).alias("_n"), *sums)
    before = F.coalesce(F.sum("_n").over(_earlier()), F.lit(0))
    return counts.withColumn("_before", before).withColumn("_all", F.sum("_n").over(whole))


def _earlier():
    return Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, n, role, text): turns in order (null first, ties by role, then text), from place 0, of n in all.

    Null roles and texts become empty. Rows without a conv_id belong to no conversation and are left out.
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    laid = _laid_out(rows, order)
    inside = F.row_number().over(Window.partitionBy("conv_id", "_block").orderBy(*order)) - 1
    spans = _blocks(laid).select("conv_id", "_block", "_before", F.col("_all").alias("n"))
    return skew_join(laid.withColumn("place", inside), spans, ["conv_id", "_block"]).select(
        "conv_id", (F.col("place") + F.col("_before")).alias("place"), "n", "role", "text"
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): every conversation c begins with the first h turns of c - c % GROUP, then has its own after its first h.

    h is crc32(c) % 9; the other conversation gives all its turns if it has fewer, and none if it is not there. ``turns`` are
    (conv_id, place, role, text); ``ids`` has each conv_id once, those without a turn included.
    """
    own = cut(numbered(conversations))
    shared = F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)
    sizes = own.groupBy("conv_id").agg(F.max("n").alias("n"))
    ids = sizes.select("conv_id", shared.alias("_h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("_base"))
    heads = own.filter(F.col("place") < MOST_SHARED).select(F.col("conv_id").alias("_base"), "place", "role", "text")
    begun = skew_join(ids, heads, "_base").filter(F.col("place") < F.col("_h")).select("conv_id", "place", "role", "text")
    bases = skew_join(ids, sizes.select(F.col("conv_id").alias("_base"), "n"), "_base", "left")
    moved = bases.select("conv_id", "_h", F.least("_h", F.coalesce("n", F.lit(0))).alias("_m"))
    rest = skew_join(own.filter(F.col("place") >= shared), moved, "conv_id").select(
        "conv_id", (F.col("place") + F.col("_m") - F.col("_h")).alias("place"), "role", "text"
    )
    return begun.unionByName(rest), ids.select("conv_id")


def _members(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, depth, _p1, _p2, _q1, _q2, bytes, last): the node of each prefix of each conversation, and that of its parent.

    A prefix is named by 120 bits: the exclusive or of the digests of its turns, each taken with its place. Those of a
    conversation are accumulated in blocks of rows, so a long conversation does not fall to one task.
    """
    digest = F.md5(F.concat_ws("\n", F.col("place"), F.length("role"), F.concat("role", "text")))
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    hashed = turns.select("conv_id", "place", part(1).alias("_x1"), part(16).alias("_x2"), F.octet_length("text").cast("long").alias("bytes"))
    laid = _laid_out(hashed, [F.col("place").asc()])
    inside = Window.partitionBy("conv_id", "_block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    blocks = _blocks(laid, F.bit_xor("_x1").alias("_b1"), F.bit_xor("_x2").alias("_b2"))
    earlier = lambda c: F.coalesce(F.bit_xor(c).over(_earlier()), F.lit(0).cast("long"))
    spans = blocks.select("conv_id", "_block", F.col("_all"), earlier("_b1").alias("_e1"), earlier("_b2").alias("_e2"))
    running = laid.withColumn("_r1", F.bit_xor("_x1").over(inside)).withColumn("_r2", F.bit_xor("_x2").over(inside))
    prefixes = skew_join(running, spans, ["conv_id", "_block"]).select(
        "conv_id", (F.col("place") + 1).cast("long").alias("depth"), *[F.col(f"_r{i}").bitwiseXOR(F.col(f"_e{i}")).alias(f"_p{i}") for i in (1, 2)],
        *[F.col(f"_r{i}").bitwiseXOR(F.col(f"_e{i}")).bitwiseXOR(F.col(f"_x{i}")).alias(f"_q{i}") for i in (1, 2)],
        "bytes", (F.col("place") + 1 == F.col("_all")).alias("last"),
    )
    begun = prefixes.filter("depth = 1").select("conv_id", F.lit(False).alias("_none"))
    zero = F.lit(0).cast("long")
    roots = skew_join(ids, begun, "conv_id", "left").select(
        "conv_id", zero.alias("depth"), zero.alias("_p1"), zero.alias("_p2"), zero.alias("_q1"), zero.alias("_q2"), zero.alias("bytes"),
        F.coalesce("_none", F.lit(True)).alias("last"),
    )
    return cut(prefixes.unionByName(roots))


def _ends(members: DataFrame) -> DataFrame:
    """(*NODE, ends_sha256): the digest of the ids of all conversations that end in a node, ascending.

    The ids are sorted by ranges, joined to pieces in each, and a node's pieces are hashed as they come: however many end in
    one node, a task holds one batch of them.
    """
    names = [*NODE, "_block", "_piece", "ids"]

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = 0
        for frame in filter(len, frames):
            # A piece ends where its node does, or with its batch.
            keys, ids = frame[[*NODE, "_block"]].to_numpy(), frame["conv_id"].tolist()
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))).tolist()
            rows = []
            for start, end in zip(starts, [*starts[1:], len(ids)], strict=True):
                for at in range(start, end, IDS_AT_ONCE):
                    rows.append((*keys[start].tolist(), count, ",".join(map(str, ids[at : min(end, at + IDS_AT_ONCE)]))))
                    count += 1
            yield pd.DataFrame(rows, columns=names)

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for frame in frames:
            rows = []
            for *key, ids in frame[[*NODE, "ids"]].itertuples(index=False):
                if key != node:
                    if node is not None:
                        rows.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(rows, columns=[*NODE, "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    keys = "depth long, _p1 long, _p2 long"
    last = members.filter("last").select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").withColumn("_block", F.spark_partition_id())
    joined = last.sortWithinPartitions(*NODE, "conv_id").mapInPandas(pieces, f"{keys}, _block int, _piece long, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "_block", "_piece").mapInPandas(digests, f"{keys}, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations: each distinct sequence of first turns (role, text) that some of them have.

    ``turns(conv_id, place, role, text)`` are numbered from 0 without gaps, with no nulls; ``ids(conv_id)`` lists every
    conversation once, also those without a turn, which end in the root. A node is named by conv_id, its smallest member,
    and depth, its number of turns; ``parent_conv_id`` is the parent's name (null for the root). ``n_convs`` counts its
    members, ``n_children`` its children, ``n_leaves`` the childless nodes in its subtree; ``saved_tokens`` sums, over its
    subtree, (n_convs - 1) times the UTF-8 bytes of a node's last text: what storing shared turns once saves.
    ``ends_sha256`` is over the ids of conversations that end in it, ascending, joined by commas. Equal conversations share
    all their nodes; no conversations give no rows.
    """
    members = _members(turns, ids)
    found = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.max("_q1").alias("_q1"), F.max("_q2").alias("_q2")
    )
    nodes = cut(found)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("_p1").alias("_q1"), F.col("_p2").alias("_q2"), F.col("conv_id").alias("parent_conv_id"))
    named = cut(skew_join(nodes, parents, ["depth", "_q1", "_q2"], "left"))
    tree = named.select(
        F.struct("conv_id", "depth").alias("node"),
        F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("parent"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = subtree_totals(tree, ["saved_tokens"]).select("node.*", "n_children", "n_leaves", "saved_tokens")
    ended = skew_join(named, _ends(members), NODE, "left")
    out = cut(
        ended.join(totals, ["conv_id", "depth"]).select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
    discard(members, nodes, named)
    return out
