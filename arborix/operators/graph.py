"""Numbers, occurrences and walks over trees and graphs kept as edge tables (TREE-9, TREE-19, SRC-8, S9).

Loops run over levels on the driver; every level is a join, checkpointed. Nothing collects a tree or the children of a node."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.package import settled, stored


def prefix_sums(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of `value` over the rows that come before each one in its group; `order` must tell all rows of a group apart.

    Rows are dealt by ranges of (by, order), so a group of any size is spread over tasks: sums within a range, and
    each range's total is carried to the later ranges that hold the same group, at most a row for each range."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settled(df.repartitionByRange(n, *by, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range", *by).agg(F.sum(value).alias("_total"))
    earlier = totals.withColumn("_carried", F.sum("_total").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))).drop("_total")
    within = ranged.withColumn("_own", F.sum(value).over(Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)))
    zero = F.lit(0).cast("long")
    return within.join(earlier, ["_range", *by]).withColumn(out, F.coalesce("_own", zero) + F.coalesce("_carried", zero)).drop("_range", "_own", "_carried")


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """A number from 0 for each row in the whole table's order."""
    return prefix_sums(df.withColumn("_one", F.lit(1).cast("long")), [], order, "_one", out).drop("_one")


def levels_of(edges: DataFrame) -> list[DataFrame]:
    """The levels of a forest (id, parent, ord) from its roots down, each (id, parent, ord, root); what no root reaches is in none."""
    out = [settled(edges.where("parent IS NULL").select("id", "parent", "ord", F.col("id").alias("root")))]
    below = edges.where("parent IS NOT NULL").select("id", "parent", "ord")
    while True:
        level = settled(below.join(out[-1].select(F.col("id").alias("parent"), "root"), "parent").select("id", "parent", "ord", "root"))
        if level.isEmpty():
            return out
        out.append(level)


def tour_numbers(edges: DataFrame) -> DataFrame:
    """S9 over a forest (id, parent, ord): (id, parent, root, depth, size, pre, post).

    `pre` numbers a tree's nodes as they are entered, `post` as they are left, both from 0, siblings by (ord, id). With `before` the nodes
    of its earlier siblings' trees, a node is entered after all nodes left before its tree and after its ancestors, so both numbers
    follow from sizes (from the leaves up), prefix sums of sizes over siblings, and sums of those from the root down.
    Ids must be distinct; ids that hang on no root get no row; a null ord comes first."""
    levels, sized, below = levels_of(edges), [], None
    for level in reversed(levels):
        size = F.lit(1).cast("long")
        if below is not None:
            level = level.join(below.groupBy(F.col("parent").alias("id")).agg(F.sum("size").alias("_below")), "id", "left")
            size = size + F.coalesce("_below", F.lit(0).cast("long"))
        below = settled(level.select("id", "parent", "ord", "root", size.alias("size")))
        sized.insert(0, below)
    if len(sized) > 1:
        inner = sized[1]
        for x in sized[2:]:
            inner = inner.unionByName(x)
        inner = settled(prefix_sums(inner, ["parent"], ["ord", "id"], "size", "before").select("id", "before"))
    out = level = sized[0].select("id", "parent", "root", "size", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("left"))
    for depth, own in enumerate(sized[1:], 1):
        above = level.select(F.col("id").alias("parent"), F.col("left").alias("_left"))
        level = settled(own.join(inner, "id").join(above, "parent").select("id", "parent", "root", "size", F.lit(depth).alias("depth"), (F.col("_left") + F.col("before")).alias("left")))
        out = out.unionByName(level)
    return out.select("id", "parent", "root", "depth", "size", (F.col("left") + F.col("depth")).alias("pre"), (F.col("left") + F.col("size") - 1).alias("post"))


def logic_ids(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """S9 over a source forest and (root, root_id, prefix): (id, logic_id, sort_order). The root has its given id and takes no number;
    others are numbered as they are entered, and stand in the order in which they are left."""
    both = tour_numbers(edges).join(roots, "root")
    name = F.when(F.col("pre") == 0, F.col("root_id")).otherwise(F.concat("prefix", F.lit("."), F.col("pre").cast("string")))
    return both.select("id", "root", name.alias("logic_id"), F.col("post").alias("sort_order"))


#: What the text of the header of admission paths holds, and what its items that are no paths hold (TREE-9).
PATH_HEADER, PATH_HEADER_ONE_OF = "admission is indicated", ("1 or more", "following")
NO_PATHS = ("not usually used", "extended stay", "goal length of stay", "discharge planning includes", "post-hospital levels", "optimal recovery course", "failure to meet discharge")


def discover_paths(nodes: DataFrame) -> DataFrame:
    """TREE-9 over nodes (code, section, id, parent, ord, text): (code, path_id, n), the paths of each code in order.

    The header is the first root of the section `<code>.section.admission` that announces paths, else its first root; paths are
    its children in order, each id once, without those whose text is noise. Null texts are empty, a null ord is 0."""
    low, place = F.lower(F.coalesce("text", F.lit(""))), F.coalesce("ord", F.lit(0))
    announces = low.contains(PATH_HEADER) & (low.contains(PATH_HEADER_ONE_OF[0]) | low.contains(PATH_HEADER_ONE_OF[1]))
    noise = F.lit(False)
    for x in NO_PATHS:
        noise = noise | low.contains(x)
    roots = nodes.where(F.col("parent").isNull() & (F.col("section") == F.concat("code", F.lit(".section.admission"))))
    header = roots.groupBy("code").agg(F.min(F.struct((~announces).alias("other"), place.alias("place"), "id")).alias("h")).select("code", F.col("h.id").alias("parent"))
    items = nodes.where(F.col("parent").isNotNull() & ~noise).select("code", "parent", "id", place.alias("place"))
    paths = items.join(header, ["code", "parent"]).groupBy("code", "id").agg(F.min("place").alias("place"))
    return paths.select("code", F.col("id").alias("path_id"), (F.row_number().over(Window.partitionBy("code").orderBy("place", "id"))).alias("n"))


#: How a render names what it can't show, by the graph that it stands in (TREE-19).
MARKERS = {"domain": ("Cycle skipped: ", "Missing logic node: "), "shared": ("Shared cycle skipped: ", "Missing shared child: ")}


def _prepared(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with whether edges lead on in their graph (`on`) and into another (`away`), and edges by the node that they leave."""
    below = stored(edges.select("graph", F.col("parent").alias("id"), "to_graph", "child", "pos"))
    leads = below.groupBy("graph", "id").agg(F.bool_or(F.col("to_graph") == F.col("graph")).alias("on"), F.bool_or(F.col("to_graph") != F.col("graph")).alias("away"))
    return stored(nodes.select("graph", "id", F.coalesce("label", F.lit("")).alias("label")).join(leads, ["graph", "id"], "left")), below


def _walk(start: DataFrame, key: list[str], known: DataFrame, below: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All that occurs from start (key, place, depth, graph, id) without leaving a graph, as (key, place, depth, graph, id, kind, label), and
    the edges that leave it, as (key, place, depth, graph, id) of what they lead to."""
    level, found = start.withColumn("above", F.array().cast("array<string>")), None
    columns = [*key, "place", "depth", "graph", "id"]
    while True:
        kind = F.when(F.array_contains("above", F.col("id")), "cycle").when(F.col("label").isNull(), "missing").otherwise("node")
        on = F.coalesce((kind == "node") & F.col("on"), F.lit(False))
        level = level.join(known, ["graph", "id"], "left").select(*columns, kind.alias("kind"), "label", "away", on.alias("on"), F.when(on, F.col("above")).alias("above"))
        level = stored(level)
        found = level if found is None else found.unionByName(level)
        going = level.where("on")
        if going.isEmpty():
            break
        graphs = [r["graph"] for r in going.select("graph").distinct().collect()]  # a domain's and the shared one
        inner = below.where(F.col("graph").isin(*graphs) & (F.col("to_graph") == F.col("graph")))
        level = going.select(*columns, "above").join(inner, ["graph", "id"]).select(*key, F.concat("place", F.array("pos")).alias("place"), (F.col("depth") + 1).alias("depth"), "graph", F.col("child").alias("id"), F.concat("above", F.array("id")).alias("above"))
    left = found.where("kind = 'node' AND away").select(*columns).join(below.where(F.col("to_graph") != F.col("graph")), ["graph", "id"])
    out = stored(left.select(*key, F.concat("place", F.array("pos")).alias("place"), (F.col("depth") + 1).alias("depth"), F.col("to_graph").alias("graph"), F.col("child").alias("id")))
    return found.select(*columns, "kind", "label"), out


def _entered(nodes: DataFrame, edges: DataFrame, roots: DataFrame):
    """Walks that occurrences are put together from: first (None, found, exits) with the key `root`, then for every crossing from one graph to another
    the list of (found, exits) with the key (in_graph, in_id) that the last exits lead into.

    What follows a crossing does not depend on what stands above it, so it is walked once for each node that is entered."""
    known, below = _prepared(nodes, edges)
    found, exits = _walk(roots.select(F.col("id").alias("root"), F.array("pos").alias("place"), F.lit(0).alias("depth"), "graph", "id"), ["root"], known, below)
    yield [(found, exits)]
    at, walks = ["graph", "id"], []
    reach = stored(exits.select(*at).distinct())
    while not reach.isEmpty():
        met, fresh = [], reach
        for w in walks:
            if not reach.join(w[0], at, "left_semi").isEmpty():
                met.append(w)
            fresh = fresh.join(w[0], at, "left_anti")
        fresh = stored(fresh)
        if not fresh.isEmpty():
            start = fresh.select(F.col("graph").alias("in_graph"), F.col("id").alias("in_id"), F.array().cast("array<bigint>").alias("place"), F.lit(0).alias("depth"), *at)
            walks.append((fresh, *_walk(start, ["in_graph", "in_id"], known, below)))
            met.append(walks[-1])
        going = [(found, None if exits.isEmpty() else exits) for _, found, exits in met]
        yield going
        reach, before = None, reach.select(F.col("graph").alias("in_graph"), F.col("id").alias("in_id"))
        for _, exits in going:
            if exits is not None:
                more = exits.join(before, ["in_graph", "in_id"], "left_semi").select(*at)
                reach = more if reach is None else reach.unionByName(more)
        if reach is None:
            return
        reach = stored(reach.distinct())


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def occurrences(nodes: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """TREE-19, ORC-5: every occurrence of a node under the roots, as (root, place, depth, graph, id, kind, line).

    nodes (graph, id, label), edges (graph, parent, to_graph, child, pos), roots (graph, id, pos). A node with several parents occurs under each
    of them. An id that stands above itself is a `cycle`, one without a node `missing`; both end there. An edge into the other graph
    starts anew, as a shared definition is guarded on its own. `place` (the positions from the root down) is the rendering's
    order. What a crossing leads into is walked once and joined to all crossings as the result is read, so only the walks and the
    crossings are stored, not what occurs below each crossing."""
    entered = _entered(nodes, edges, roots)
    found, level = next(entered)[0]
    out, columns = [found], ["root", "place", "depth", "graph", "id", "kind", "label"]
    for walks in entered:
        tops = level.select("root", F.col("place").alias("_place"), F.col("depth").alias("_depth"), F.col("graph").alias("in_graph"), F.col("id").alias("in_id"))
        under = lambda x: tops.join(x, ["in_graph", "in_id"]).withColumn("place", F.concat("_place", "place")).withColumn("depth", F.col("_depth") + F.col("depth"))  # noqa: B023, E731
        out += [under(f).select(*columns) for f, _ in walks]
        further = [under(x).select(*columns[:5]) for _, x in walks if x is not None]
        level = _united(further) if further else None
    marks = [F.create_map(*(F.lit(x) for g, m in MARKERS.items() for x in (g, m[k]))) for k in (0, 1)]
    line = F.when(F.col("kind") == "node", F.col("label")).otherwise(F.concat(F.when(F.col("kind") == "cycle", marks[0][F.col("graph")]).otherwise(marks[1][F.col("graph")]), "id"))
    return _united(out).select(*columns[:6], line.alias("line"))


def occurrence_counts(nodes: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """How many occurrences of each kind in each graph every root has, and how deep the deepest is: (root, graph, kind, deepest, n).

    Crossings into the same node are counted together, as what follows them is alike; no occurrence below them is made."""
    flat = lambda df: df.withColumn("pos", F.lit(None).cast("bigint"))
    entered = _entered(nodes.withColumn("label", F.lit("")), flat(edges), flat(roots))
    found, exits = next(entered)[0]
    n, at = F.count("*").alias("n"), ["in_graph", "in_id"]
    out = [found.groupBy("root", "graph", "kind").agg(F.max("depth").alias("deepest"), n)]
    level = exits.groupBy("root", F.col("graph").alias("in_graph"), F.col("id").alias("in_id")).agg(F.max("depth").alias("_deepest"), F.count("*").alias("_n"))
    for walks in entered:
        level = stored(level)

        def under(x, by):
            rows = level.join(x.groupBy(*at, *by).agg(F.max("depth").alias("d"), n), at)  # noqa: B023
            return rows.groupBy("root", *by).agg(F.max(F.col("_deepest") + F.col("d")).alias("deepest"), F.sum(F.col("_n") * F.col("n")).alias("n"))

        out += [under(f, ["graph", "kind"]) for f, _ in walks]
        further = [under(x, ["graph", "id"]) for _, x in walks if x is not None]
        if further:
            level = _united(further).groupBy("root", F.col("graph").alias("in_graph"), F.col("id").alias("in_id")).agg(F.max("deepest").alias("_deepest"), F.sum("n").alias("_n"))
    return _united(out).groupBy("root", "graph", "kind").agg(F.max("deepest").alias("deepest"), F.sum("n").alias("n"))


def crawl(links: DataFrame, starts: DataFrame, most: int, most_leaves: int) -> DataFrame:
    """SRC-8 over links (src, dst, pos, leaf) from starts (url, pos): (url, kind, round, parent, n, taken).

    Pages are visited first in, first out, each once: in the order of the page that first links to them, then of the link's position.
    The first `most` pages are taken; what those link to beyond is listed as not taken. Links marked `leaf` are not followed: leaves
    are numbered in the order of their first link, and the first `most_leaves` are taken. A round's pages are numbered by prefix
    sums over ranges, so no frontier passes through one task; a null src or dst links nothing."""
    good = links.where("src IS NOT NULL AND dst IS NOT NULL")
    follow, n = good.where("NOT leaf"), 0
    first = starts.where("url IS NOT NULL").groupBy("url").agg(F.min("pos").alias("pos"))
    new = settled(numbered(first, ["pos", "url"], "n").select("url", F.lit(0).alias("round"), F.lit(None).cast("string").alias("parent"), "n"))
    seen, step = new, 0
    while not new.isEmpty():
        n, step = n + new.count(), step + 1
        if n >= most:
            break
        found = follow.join(new.select(F.col("url").alias("src"), F.col("n").alias("p")), "src").groupBy(F.col("dst").alias("url")).agg(F.min(F.struct("p", "pos", "src")).alias("f"))
        fresh = found.join(seen, "url", "left_anti").select("url", F.col("f.p").alias("p"), F.col("f.pos").alias("pos"), F.col("f.src").alias("parent"))
        new = settled(numbered(fresh, ["p", "pos", "url"], "k").select("url", F.lit(step).alias("round"), "parent", (F.col("k") + n).alias("n")))
        seen = settled(seen.unionByName(new))
    taken = F.col("n") < most
    pages = seen.select("url", F.lit("page").alias("kind"), "round", "parent", "n", taken.alias("taken"))
    ends = good.where("leaf").join(seen.where(taken).select(F.col("url").alias("src"), F.col("n").alias("p"), "round"), "src")
    ends = ends.groupBy(F.col("dst").alias("url")).agg(F.min(F.struct("p", "pos", "src", "round")).alias("f")).select("url", "f.*")
    leaves = numbered(ends, ["p", "pos", "url"], "n").select("url", F.lit("leaf").alias("kind"), (F.col("round") + 1).alias("round"), F.col("src").alias("parent"), "n", (F.col("n") < most_leaves).alias("taken"))
    return pages.unionByName(leaves)
