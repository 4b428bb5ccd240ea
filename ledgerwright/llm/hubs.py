"""Components of links, completed inside dense groups by hubs first and by an exact prefix join for the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.llm.components import components
from ledgerwright.llm.shared import Workspace

#: A cell has another round while each joins this share of its components; the prefix join completes the others.
YIELD = 0.1
#: Hubs of a cell in one round, each of another component.
HUBS = 8
#: Prefix pieces kept with the one behind them: two sets that share one of these have met there.
BEFORE = 8


def hub_components(
    space: Workspace,
    dense: DataFrame,
    tried: DataFrame,
    links: DataFrame,
    confirmed: Callable[[DataFrame], DataFrame],
    exact: Callable[[DataFrame], DataFrame],
    sets: Callable[[DataFrame], DataFrame],
    percent: int,
    hubs: int = HUBS,
    small: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all linked nodes, and all links.

    ``dense`` has (cell, node), ``tried`` and ``links`` have (a, b) with a > b; ``confirmed``
    and ``exact`` keep the pairs that are links. ``sets`` gives (node, key, pieces) of the
    given nodes: the distinct pieces of every set of a node, told apart by the key.

    While a cell holds several components, its members are compared with the hubs of other
    components: in each of the first ``hubs`` components the node with most links so far,
    the least one among equals, another one in each round. A round is linear in the cells.
    A cell whose components become fewer by less than ``YIELD`` in a round has no further
    one, and a cell of up to ``small`` members has one round only. Members of such cells that are still
    in different components are then compared by ``_apart``, which misses no link.
    """
    labels = components(space, links)
    if not dense.limit(1).count():
        return labels, links
    members, used, before, late = dense.distinct(), None, None, None
    while True:
        ends = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node")))
        degrees = ends.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
        state = space.store(labels.join(degrees, "node"), "state")
        named = members.join(state, "node", "left").select(
            "cell", "node", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")
        )
        named = space.store(named, "named")
        parts = named.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("n"))
        mixed = parts.groupBy("cell").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n")).where("parts > 1")
        last = F.lit(False)
        if before is not None:
            mixed = mixed.join(before.withColumnRenamed("parts", "before"), "cell")
            last = (F.col("n") <= small) | (F.col("parts") > (1 - YIELD) * F.col("before"))
        mixed = space.store(mixed.select("cell", "parts", last.alias("ends")), "mixed")
        # The members of mixed cells are joined once a round; what follows reads these.
        judged = space.store(named.join(mixed.hint("merge"), "cell"), "judged")
        ended = judged.where("ends").select("cell", "node")
        late = ended if late is None else late.unionAll(ended)
        named, mixed = judged.where("NOT ends"), mixed.where("NOT ends").select("cell", "parts")
        cells = mixed.count()
        if not cells:
            break
        free = named
        if used is not None:
            free = free.join(used, ["cell", "node"], "left_anti")
        best = F.max(F.struct("links", (-F.col("node")).alias("minus"))).alias("best")
        ranked = free.groupBy("cell", "component").agg(best)
        first = F.row_number().over(Window.partitionBy("cell").orderBy(F.col("best").desc()))
        chosen = ranked.withColumn("rank", first).where(F.col("rank") <= hubs)
        chosen = chosen.select("cell", (-F.col("best.minus")).alias("hub"), F.col("component").alias("own"))
        chosen = space.store(chosen, "hubs", hubs * cells)
        fresh = (
            named.join(chosen, "cell")
            .where("component != own")
            .select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b"))
            .distinct()
        )
        fresh = space.store(fresh.join(tried, ["a", "b"], "left_anti"), "hub-pairs")
        more = confirmed(fresh)
        if found := more.count():
            links, labels = links.unionAll(more), _joined(space, labels, more, found)
        tried = tried.unionAll(fresh)
        now = chosen.select("cell", F.col("hub").alias("node"))
        used, before = now if used is None else used.unionAll(now), mixed
        members = named.select("cell", "node")
    named = late.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = space.store(named, "late")
    spread = named.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    nodes = named.join(spread.where("low < high"), "cell", "left_semi").select("node", "component").distinct()
    nodes = space.store(nodes, "late-nodes")
    if not nodes.limit(1).count():
        return labels, links
    more = exact(_apart(space, nodes, sets(nodes), percent))
    found = more.count()
    if not found:
        return labels, links
    return _joined(space, labels, more, found), links.unionAll(more)


def _prefixes(space: Workspace, sets: DataFrame, percent: int) -> DataFrame:
    """(piece, node, size, rest, before) of the rarest pieces of every set, as many as two linked sets cannot both be without.

    Two sets of similarity ``percent`` share a piece among the first size - ceil(percent x size) + 1 of each in any
    common order. Rare pieces come first, so what most sets share is in few prefixes. ``rest`` counts the pieces behind.
    ``before`` has the last ``BEFORE`` pieces of the set before this one in that order.
    """
    pieces = sets.select("node", "key", F.size("pieces").alias("size"), F.explode("pieces").alias("piece"))
    often = space.store(pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    # Pieces of one set only are the rarest; they lead nowhere and are only counted.
    ranked = pieces.join(often, "piece").groupBy("node", "key", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "piece"))).alias("ranked")
    )
    take = F.expr(f"size(ranked) - (({percent} * size + 99) DIV 100) + 1").cast("int")
    taken = ranked.withColumn("take", take).where("take > 0")
    # Spark evaluates what the explosion needs along with the condition, so the length must be valid without it, too.
    front = F.transform(F.slice("ranked", 1, F.greatest("take", F.lit(0))), lambda x: x["piece"])
    taken = taken.select("node", "size", F.size("ranked").alias("all"), front.alias("front"))
    taken = taken.select("node", "size", "all", "front", F.posexplode("front").alias("place", "piece"))
    before = F.slice("front", F.greatest(F.col("place") - (BEFORE - 1), F.lit(1)), F.least("place", F.lit(BEFORE)))
    return taken.select("node", "size", (F.col("all") - F.col("place") - 1).alias("rest"), "piece", before.alias("before"))


def _apart(space: Workspace, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of ``nodes`` (node, component) in different components that can be links.

    Pairs share a prefix piece and can still reach the similarity behind it. Those of a
    piece's largest component are compared with its other nodes only, not with each other.
    """
    held = space.store(_prefixes(space, sets, percent).join(nodes, "node"), "prefixes")
    parts = held.groupBy("piece", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("piece").agg(
        F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("parts")
    )
    main = space.store(main.where("parts > 1").select("piece", F.col("most.component").alias("main")), "piece-parts")
    held = space.store(held.join(main, "piece").withColumn("main", F.col("component") == F.col("main")), "apart")
    return space.store(_met(held, percent).distinct(), "apart-pairs")


def _met(held: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share a prefix piece (``held``), hardly more than once each.

    A pair that shares one of the last pieces before this one, too, is left to that one: its first shared piece has no
    such piece before it, and all that is asked of the others holds there.
    """
    other = held.select(
        "piece", *[F.col(c).alias(f"other_{c}") for c in ("node", "size", "rest", "component", "main", "before")]
    )
    pairs = (
        held.where("NOT main")
        .join(other, "piece")
        .where("component != other_component AND (other_main OR node > other_node)")
        .where(f"100 * least(size, other_size) >= {percent} * greatest(size, other_size)")
        .where(f"(1 + least(rest, other_rest)) * {100 + percent} >= {percent} * (size + other_size)")
        .where("NOT arrays_overlap(before, other_before)")
    )
    return pairs.select(F.greatest("node", "other_node").alias("a"), F.least("node", "other_node").alias("b"))


def _joined(space: Workspace, labels: DataFrame, more: DataFrame, found: int) -> DataFrame:
    """Labels after some more links, ``found`` of them, from the components of the linked components."""

    def named(side):
        return F.coalesce(F.col(f"{side}_label"), F.col(side)).alias(side)

    lifted = more
    for side in ("a", "b"):
        lifted = lifted.join(labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_label")), side, "left")
    lifted = space.store(lifted.select(named("a"), named("b")).distinct(), "lifted", found)
    over = components(space, lifted).select(F.col("node").alias("component"), F.col("component").alias("root"))
    kept = labels.join(over, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    new = over.join(labels, F.col("node") == over["component"], "left_anti").select(
        F.col("component").alias("node"), F.col("root").alias("component")
    )
    return space.store(kept.unionAll(new), "components")
