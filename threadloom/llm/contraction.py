"""Subtree totals of forests by parallel contraction: leaves are raked and unary chains compressed in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.skew import skew_join
from threadloom.session import cut, discard


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(node, n_children, n_leaves, *values): for each node its children, and over its whole subtree, itself included, the
    childless nodes and the sums of ``values``.

    ``tree(node, parent, *values)`` has one row a node, of any type; roots have a null parent, other parents are nodes, and
    there are no circles. A null value counts as 0. No rows give no rows.

    A round first compresses: every maximal chain of nodes with one child is replaced by the node at its end, found by
    doubling the reach of the chain's links, and what the chain held becomes the weight of that node's link. Then it rakes:
    nodes without children add their totals and their link's weight to their parent. Every node that is left had two
    children or more, so the leaves at least halve in each round and the rounds grow with the logarithm of the tree's size
    only, however deep it is. Afterwards the chains are expanded again, last round first: the total of a node in a chain is
    that of the chain's end and what the chain holds below. A node with very many children is summed by an aggregate that
    combines before it shuffles, and one with a very long chain above is met by a join that can be split.
    """
    sums = ["n_leaves", *values]
    own, link, below = ([f"_{kind}{i}" for i in range(len(sums))] for kind in ("own", "link", "below"))
    alive = tree.select(
        "node", "parent", F.lit(None).cast("long").alias("n_children"), F.lit(0).cast("long").alias(own[0]),
        *[F.coalesce(F.col(v), F.lit(0)).cast("long").alias(o) for v, o in zip(values, own[1:], strict=True)],
        *[F.lit(0).cast("long").alias(x) for x in link],
    )
    kept: list[DataFrame] = []
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while True:
        families = alive.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
            F.count(F.lit(1)).alias("_kids"), F.min("node").alias("_child"), *[F.sum(x).alias(b) for x, b in zip(link, below, strict=True)]
        )
        found = alive.join(families, "node", "left").withColumn("_kids", F.coalesce("_kids", F.lit(0)))
        if not rounds:
            found = found.withColumn("n_children", F.col("_kids")).withColumn(own[0], (F.col("_kids") == 0).cast("long"))
        state = cut(found)
        kept.append(state)
        unary = (F.col("_kids") == 1) & F.col("parent").isNotNull()
        chains = _chains(state.filter(unary), own, link, below)
        rest = state.filter(~unary)
        if chains is not None:
            kept.append(chains)
            top = F.max_by(F.struct("parent", *[(F.col(o) + F.col(x)).alias(x) for o, x in zip(own, link, strict=True)]), "_steps")
            ends = chains.groupBy(F.col("_to").alias("node")).agg(top.alias("_top"))
            rest = rest.join(ends, "node", "left").withColumns(
                {"parent": F.coalesce("_top.parent", "parent"), **{x: F.coalesce(f"_top.{x}", x) for x in link}}
            )
        rest = cut(rest.select("node", "parent", "n_children", "_kids", *own, *link))
        kept.append(rest)
        leaves = rest.filter("_kids = 0")
        rounds.append((leaves.select("node", "n_children", *own), chains))
        inner = rest.filter("_kids > 0")
        if inner.isEmpty():
            break
        raked = leaves.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.col(o) + F.col(x)).alias(b) for o, x, b in zip(own, link, below, strict=True)]
        )
        alive = inner.join(raked, "node", "left").select(
            "node", "parent", "n_children", *[(F.col(o) + F.coalesce(b, F.lit(0))).alias(o) for o, b in zip(own, below, strict=True)], *link
        )
    totals = None
    for leaves, chains in reversed(rounds):
        totals = leaves if totals is None else totals.unionByName(leaves)
        if chains is not None:
            known = totals.select(F.col("node").alias("_to"), *[F.col(o).alias(b) for o, b in zip(own, below, strict=True)])
            expanded = cut(
                skew_join(chains.select("node", "_to", "n_children", *own), known, "_to")
                .select("node", "n_children", *[(F.col(o) + F.col(b)).alias(o) for o, b in zip(own, below, strict=True)])
            )
            kept.append(expanded)
            totals = totals.unionByName(expanded)
    done = cut(totals.select("node", "n_children", *[F.col(o).alias(s) for o, s in zip(own, sums, strict=True)]))
    discard(*kept)
    return done


def _chains(unary: DataFrame, own: list[str], link: list[str], below: list[str]) -> DataFrame | None:
    """(node, parent, n_children, _to, _steps, own, link) for nodes with one child: ``_to`` ends the node's chain below, and
    ``own`` is all that the chain holds from the node to there. None without such nodes.

    Each round joins the links that have not come to an end with all links, so a link reaches twice as far.
    """
    weights = [(F.col(o) + F.col(b)).alias(o) for o, b in zip(own, below, strict=True)]
    links = cut(unary.select("node", "parent", "n_children", F.col("_child").alias("_to"), F.lit(1).cast("long").alias("_steps"), F.lit(True).alias("_on"), *weights, *link))
    if links.isEmpty():
        discard(links)
        return None
    while not links.filter("_on").isEmpty():
        ahead = links.select(F.col("node").alias("_to"), F.struct("_to", "_steps", "_on", *own).alias("_next"))
        met = links.filter("_on").join(ahead, "_to", "left").withColumns({
            "_on": F.coalesce("_next._on", F.lit(False)), "_to": F.coalesce("_next._to", "_to"),
            "_steps": F.col("_steps") + F.coalesce("_next._steps", F.lit(0)), **{o: F.col(o) + F.coalesce(f"_next.{o}", F.lit(0)) for o in own},
        })
        further = cut(links.filter("NOT _on").unionByName(met.drop("_next")))
        discard(links)
        links = further
    return links
