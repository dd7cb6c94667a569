"""Exact links among texts that may be similar: one spanning forest, never all pairs of a group."""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Scratch
from panelcast.llm.graph import connected_components

LINKS = "u long, v long, small long, large long, sure boolean"


def shared_hashes(left: Column, right: Column) -> Column:
    """How many hashes two packed sets share."""

    @F.pandas_udf("long")
    def shared(left: pd.Series, right: pd.Series) -> pd.Series:
        unpacked = ((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(left, right))
        return pd.Series([len(np.intersect1d(a, b, assume_unique=True)) for a, b in unpacked], dtype="int64")

    return shared(left, right)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (``u``, ``v`` with their sizes ``small``, ``large``), those whose full sets are similar enough."""
    u = sets.select(F.col("node").alias("u"), F.col("set").alias("u_set"))
    v = sets.select(F.col("node").alias("v"), F.col("set").alias("v_set"))
    fit = pairs.filter(100 * F.col("small") >= percent * F.col("large"))
    both = fit.join(u, "u").join(v, "v").withColumn("shared", shared_hashes("u_set", "v_set"))
    return both.filter(100 * F.col("shared") >= percent * (F.col("small") + F.col("large") - F.col("shared"))).select("u", "v")


def _hashes(sets: Column) -> Column:
    @F.pandas_udf("array<long>")
    def unpack(sets: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, np.int64) for x in sets], dtype=object)

    return unpack(sets)


def _unlike(own: Column, usual: Column) -> Column:
    """Hashes in which a set and the usual one differ."""

    @F.pandas_udf("array<long>")
    def differ(own: pd.Series, usual: pd.Series) -> pd.Series:
        pairs = ((np.asarray(a, np.int64), np.asarray([] if b is None else b, np.int64)) for a, b in zip(own, usual))
        return pd.Series([np.setxor1d(a, b, assume_unique=True) for a, b in pairs], dtype=object)

    return differ(own, usual)


def _against_usual(work: DataFrame) -> DataFrame:
    """``work`` (``g``, ``node``, ``n``, ``component``, ``delta``) with each difference taken to the hashes that most members
    of the group hold, and its size ``m``. Differences between two members stay what they are."""
    counts = work.select("g", F.explode("delta").alias("h")).groupBy("g", "h").agg(F.count("*").alias("f"))
    total = work.groupBy("g").agg(F.count("*").alias("of"))
    usual = counts.filter("f > 1").join(total, "g").filter("2 * f > of").groupBy("g").agg(F.collect_list("h").alias("usual"))
    unlike = work.join(usual, "g", "left").withColumn("delta", _unlike("delta", "usual"))
    return unlike.select("g", "node", "n", "component", "delta", F.size("delta").cast("long").alias("m"))


def _listed(unlike: DataFrame, percent: int, carry: int) -> DataFrame:
    """Members by the early hashes of their differences, from the rarest on, as far as others of the group hold them.

    Two linked members whose differences are too large together share a hash in this part of both (prefix filter:
    the first one they share leaves enough behind it). Differences of up to ``carry`` hashes go along.
    """
    each = unlike.select("g", "node", F.explode("delta").alias("h"))
    shared = each.groupBy("g", "h").agg(F.count("*").alias("f")).filter("f > 1")
    ordered = each.join(shared, ["g", "h"]).groupBy("g", "node").agg(F.sort_array(F.collect_list(F.struct("f", "h"))).alias("o"))
    # Hashes that no other member holds come first; they meet nothing.
    rows = unlike.join(ordered, ["g", "node"]).select("*", F.posexplode("o").alias("i", "e"))
    rows = rows.withColumn("pos", F.col("m") - F.size("o") + F.col("i")).filter(percent * F.col("pos") <= (100 - percent) * F.col("n"))
    carried = F.when(F.col("m") <= carry, F.col("delta")).alias("carried")
    return rows.select("g", F.col("e.h").alias("h"), "node", "n", "component", "m", "pos", carried)


def _shared_counts(lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many values every two rows share; row i holds the next ``lengths[i]`` of ``values``."""
    k = len(lengths)
    out = np.zeros((k, k), np.float32)
    _, index, times = np.unique(values, return_inverse=True, return_counts=True)
    common = times[index] > 1
    row, index = np.repeat(np.arange(k), lengths)[common], index[common]
    if not len(index):
        return out
    _, index = np.unique(index, return_inverse=True)
    order = np.argsort(index, kind="stable")
    row, index = row[order], index[order]
    for low in range(0, int(index[-1]) + 1, 4096):
        a, b = np.searchsorted(index, (low, low + 4096))
        block = np.zeros((k, min(4096, int(index[-1]) + 1 - low)), np.float32)
        block[row[a:b], index[a:b] - low] = 1
        out += block @ block.T
    return out


def _forest(linked: np.ndarray, component: np.ndarray) -> tuple[list, list, np.ndarray]:
    """Edges of a spanning forest of the links between components, and the components after it."""
    _, name = np.unique(component, return_inverse=True)
    us, vs, seen = [], [], np.zeros(len(linked), bool)
    for start in range(len(linked)):
        queue = [] if seen[start] else [start]
        seen[start] = True
        for i in queue:
            new = np.flatnonzero(linked[i] & ~seen)
            seen[new] = True
            queue += new.tolist()
            for j in new:
                if name[i] != name[j]:
                    us.append(i)
                    vs.append(j)
                    name[name == name[j]] = name[i]
    return us, vs, name


def _links_of_list(table: pa.Table, percent: int, across: bool) -> pa.RecordBatch | None:
    """Links in one list: a forest of those that the carried differences decide, and pairs left to verify."""
    node, n, component, m, pos, part = (table.column(c).to_numpy() for c in ("node", "n", "component", "m", "pos", "part"))
    carried = table.column("carried").combine_chunks()
    lengths = carried.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    short = lengths >= 0
    # Twice the hashes of both differences that a link needs in common, times 100 + percent.
    need = (100 + percent) * (m[:, None] + m) - (100 - percent) * (n[:, None] + n)
    fit = 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    if across:
        fit &= part[:, None] != part
    own = np.flatnonzero(short)
    shared = np.zeros((len(n), len(n)), np.float32)
    shared[np.ix_(own, own)] = _shared_counts(lengths[own], carried.flatten().to_numpy(zero_copy_only=False))
    both = short[:, None] & short
    linked = fit & both & (2 * (100 + percent) * shared.astype(np.int64) >= need)
    np.fill_diagonal(linked, False)
    us, vs, name = _forest(linked, component)
    sure = len(us)
    if not short.all():
        rest = m - pos
        open_ = fit & ~both & (need > 0) & (2 * (100 + percent) * np.minimum(rest[:, None], rest) >= need)
        i, j = np.nonzero(np.triu(open_ & (name[:, None] != name), 1))
        us, vs = us + i.tolist(), vs + j.tolist()
    if not us:
        return None
    low, high, small, large = (f(x[us], x[vs]) for x in (node, n) for f in (np.minimum, np.maximum))
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, (low, high, small, large)), pa.array(np.arange(len(us)) < sure)], ["u", "v", "small", "large", "sure"]
    )


def _links_of_lists(rows: DataFrame, percent: int) -> DataFrame:
    """``_links_of_list`` for every (``g``, ``h``, ``x``, ``y``) of the rows."""
    keys = ["g", "h", "x", "y"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            held, done = _finished(held, keys)
            yield from _solved(done)
        if held is not None and len(held):
            yield from _solved(_split(held, keys))

    def _solved(tables) -> Iterator[pa.RecordBatch]:
        for one in tables:
            found = _links_of_list(one, percent, one.column("x")[0] != one.column("y")[0])
            if found is not None:
                yield found

    columns = [*keys, "part", "node", "n", "component", "m", "pos", "carried"]
    dealt = rows.select(*columns).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(solve, LINKS)


def _borders(table: pa.Table, keys: list[str]) -> np.ndarray:
    columns = [table.column(k).to_numpy() for k in keys]
    return np.flatnonzero(reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))) + 1


def _split(table: pa.Table, keys: list[str]) -> list[pa.Table]:
    borders = [0, *_borders(table, keys).tolist(), len(table)]
    return [table.slice(a, b - a) for a, b in zip(borders, borders[1:])]


def _finished(table: pa.Table, keys: list[str]) -> tuple[pa.Table, list[pa.Table]]:
    """The last list, which may go on, and those before it."""
    lists = _split(table, keys)
    return lists[-1], lists[:-1]


def spanning_links(
    met: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, part: int = 1_000, carry: int = 256, rounds: int = 3
) -> DataFrame:
    """``(u, v)``: links that join exactly the nodes which all links between nodes that met join.

    ``met`` (``u``, ``v``) joins the nodes that have a bucket in common; ``sets`` (``node``, ``set``) holds their packed hashes.

    Nodes that met, directly or over others, form a group. A set is replaced by its difference to the hashes that
    most sets of its group hold, which keeps the symmetric difference of any two sets and leaves near copies of one
    text little in common. Two sets with so small differences that they are linked whatever these share are both
    linked with the set of the smallest difference: one star a group, however large. All others share one of the early
    hashes of their differences (``_listed``) and meet in its list. Lists that hold several components are decided in a
    task of their own, which hands on a spanning forest; only pairs with a difference of more than ``carry`` hashes are
    verified one by one. Lists of more than ``part`` rows become groups of the next round, with a usual set of their own;
    those left after ``rounds`` are compared in blocks.
    """
    groups = connected_components(met.select("u", "v"))
    work = groups.join(sets, "node").select(
        F.col("component").alias("g"),
        "node",
        (F.length("set") / 8).cast("long").alias("n"),
        F.col("node").alias("component"),
        _hashes("set").alias("delta"),
    )
    edges: DataFrame | None = None
    for turn in range(rounds):
        work = scratch.stage(work, "groups")
        unlike = scratch.stage(_against_usual(work), "differences")
        room = (100 - percent) * F.col("n") - (100 + percent) * F.col("m")
        centre = F.max_by(F.struct("node", "component"), F.struct(room, "node"))
        near = unlike.groupBy("g").agg(centre.alias("c"), F.max(room).alias("most"))
        joined = unlike.join(near, "g").withColumn("close", room + F.col("most") >= 0)
        star = joined.filter(F.col("close") & (F.col("c.component") != F.col("component")))
        star = star.select(F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v"))
        unlike = joined.withColumn("component", F.when(F.col("close"), F.col("c.component")).otherwise(F.col("component")))
        unlike = unlike.select("g", "node", "n", "component", "delta", "m")

        listed = scratch.stage(_listed(unlike, percent, carry), "lists")
        lists = listed.groupBy("g", "h").agg(
            F.count("*").alias("rows"),
            F.sum(F.greatest(F.size("carried"), F.lit(0))).alias("load"),
            F.min("component").alias("a"),
            F.max("component").alias("b"),
        )
        parts = F.ceil(F.greatest(F.col("rows") / part, F.col("load") / (1_000 * part))).cast("int")
        lists = scratch.stage(lists.filter("a < b").select("g", "h", parts.alias("parts")), "mixed-lists")
        small = listed.join(lists.filter("parts = 1"), ["g", "h"])
        small = small.withColumns({c: F.lit(0) for c in ("part", "x", "y")})
        more = lists.filter("parts > 1")
        found = _links_of_lists(small, percent)
        ended = more.isEmpty()
        if not ended and turn == rounds - 1:
            blocks = listed.join(more, ["g", "h"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
            blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            blocks = blocks.withColumns({"x": F.least("part", "other"), "y": F.greatest("part", "other")})
            found, ended = found.unionByName(_links_of_lists(blocks, percent)), True
        found = scratch.stage(found, "list-links")
        sure = found.filter("sure").select("u", "v")
        rest = verified(found.filter("NOT sure").select("u", "v", "small", "large").distinct(), sets, percent)
        here = scratch.stage(star.unionByName(sure).unionByName(rest).distinct(), "links")
        edges = here if edges is None else edges.unionByName(here)
        if ended:
            return edges
        labels = connected_components(edges)
        large = listed.join(more, ["g", "h"]).select("g", F.xxhash64("g", "h").alias("next"), "node")
        work = large.join(unlike.select("g", "node", "n", "delta"), ["g", "node"]).join(labels, "node", "left")
        work = work.select(F.col("next").alias("g"), "node", "n", F.coalesce("component", "node").alias("component"), "delta")
        mixed = work.groupBy("g").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a < b").select("g")
        work = work.join(mixed, "g", "left_semi")
    return edges
