"""Groups of similar items from inverted lists, without giving all pairs of a long list."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.components import components
from dockyard.llm.rolling import ragged
from dockyard.llm.tables import dropped, in_files, release, staged

#: Members of a component, and documents held against it, that are compared in one task: as many as have so many
#: values together, and not more than so many. A block is sent to every block it meets.
VALUES, BLOCK = 1 << 19, 1024
#: Rows that a file has, at least: of ids; list rows that give the pairs of a file; pairs compared for a file of links.
ROWS, LISTED, PAIRS = 1 << 16, 1 << 14, 1 << 10


def similar_size(percent: int, a: str, b: str) -> Column:
    """Sets whose sizes differ more can't have a Jaccard similarity of ``percent`` per cent."""
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _flat(full: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(full), np.fromiter(map(len, full), np.int64, len(full))


def _alike(met: DataFrame, percent: int) -> DataFrame:
    met = met.withColumn("_i", F.size(F.array_intersect("_fa", "_fb")))
    total = F.size("_fa") + F.size("_fb") - F.col("_i")
    return met.filter(F.col("_i") * 100 >= total * percent).select("a", "b")


def linked_groups(lists: DataFrame, percent: int, sets: Callable[[DataFrame], DataFrame], list_size: int,
                  promising: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
                  alike: Callable[[DataFrame, int], DataFrame] = _alike,
                  flat: Callable[[Sequence], tuple[np.ndarray, np.ndarray]] = _flat,
                  spent: Sequence[DataFrame] = ()) -> DataFrame:
    """``node, component`` of every node with a Jaccard similarity of ``percent`` per cent or more to another.

    ``lists`` (written, with ``v, node, n``: list, member, size of its set)
    brings together what may be similar. ``sets`` gives ``node, _full`` (the
    full set as an array) for a frame of nodes, ``promising`` may drop pairs
    that can't be similar. ``_full`` may be what a set is made from instead,
    which is often smaller: then ``alike`` gives the similar ``a, b`` of
    ``a, b, _fa, _fb`` and ``flat`` the distinct values of several sets in a
    row and how many each has. ``spent`` are staged tables that only ``lists``
    and ``promising`` read: they are deleted when the candidates are written.

    Lists up to ``list_size`` give all their pairs. In a longer list every
    member meets one hub, the member that is in most long lists, as copies of
    a text share more with it than with each other. What is linked forms
    components. Members of a long list that aren't in the list's largest
    component are then held against that whole component and against each
    other, in blocks and on full sets, and give a spanning forest of their
    links. So a long list of near copies costs about its length in rows, and
    no link between components is left out.
    """
    many = lists.count()

    def exact(pairs: DataFrame) -> DataFrame:
        near = staged(in_files(promising(pairs.distinct()), many, LISTED))
        for table in spent:
            dropped(table)
        full = staged(sets(near.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
        met = (near.join(full.select(F.col("node").alias("a"), F.col("_full").alias("_fa")), "a")
               .join(full.select(F.col("node").alias("b"), F.col("_full").alias("_fb")), "b"))
        out = staged(in_files(alike(met.select("a", "b", "_fa", "_fb"), percent), near.count(), PAIRS))
        dropped(full)
        return out

    sizes = lists.groupBy("v").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    short = lists.join(sizes.filter(F.col("c") <= list_size).select("v"), "v")
    long_ = staged(in_files(lists.join(sizes.filter(F.col("c") > list_size).select("v"), "v").select("v", "node", "n"), many, ROWS))
    degree = long_.groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    hub = (long_.join(degree, "node").groupBy("v")
           .agg(F.max_by(F.struct("node", "n"), F.struct("d", F.xxhash64("node"), "node")).alias("h"))
           .select("v", "h.node", "h.n"))
    links = exact(_pairs(short, short, F.col("xn") < F.col("yn"), percent)
                  .union(_pairs(long_, hub, F.col("xn") != F.col("yn"), percent)))
    release(lists.sparkSession)
    groups = components(links)
    want = _apart(long_, groups)
    if want.isEmpty():
        return groups
    return components(links.union(_against(want, groups, sets, percent, flat)))


def _pairs(x: DataFrame, y: DataFrame, on: Column, percent: int) -> DataFrame:
    left = x.select(F.col("v").alias("xv"), F.col("node").alias("xn"), F.col("n").alias("na"))
    right = y.select(F.col("v").alias("yv"), F.col("node").alias("yn"), F.col("n").alias("nb"))
    met = left.join(right, (F.col("xv") == F.col("yv")) & on & similar_size(percent, "na", "nb"))
    return met.select(F.least("xn", "yn").alias("a"), F.greatest("xn", "yn").alias("b"))


def _apart(long_: DataFrame, groups: DataFrame) -> DataFrame:
    """``d, g``: members of a list that aren't in its largest component, and that component."""
    labelled = long_.join(groups, "node", "left").select("v", "node", F.coalesce("component", "node").alias("own"))
    main = (labelled.groupBy("v", "own").agg(F.count(F.lit(1)).alias("c")).groupBy("v")
            .agg(F.max_by("own", F.struct("c", "own")).alias("g"), F.count(F.lit(1)).alias("_groups")).filter("_groups > 1"))
    want = labelled.join(main.select("v", "g"), "v").filter("own <> g").select(F.col("node").alias("d"), "g").distinct()
    return staged(in_files(want, long_.count(), ROWS))


def _against(want: DataFrame, groups: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int,
             flat: Callable[[Sequence], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``a, b``: links of each ``d, g`` of ``want`` to members of component g and to other d of that g.

    Per pair of blocks a spanning forest is given: links that join nothing new
    are left out, members of g count as joined already.
    """
    own = want.select("g").distinct()
    members = groups.select("node", F.col("component").alias("g")).join(own, "g", "left_semi").select("node", "g").union(
        own.join(groups.select(F.col("node").alias("g")), "g", "left_anti").select(F.col("g").alias("node"), "g"))
    others = want.select(F.col("d").alias("node"), "g")
    all_ = staged(in_files(members.withColumn("inside", F.lit(True)).union(others.withColumn("inside", F.lit(False))),
                           groups.count() + want.count(), ROWS))
    full = staged(sets(all_.select("node").distinct()))
    weight = (F.size if dict(full.dtypes)["_full"].startswith("array") else F.length)("_full")
    held = all_.join(full.select("node", weight.alias("w")), "node", "left")

    def blocks(own: Column) -> Column:
        return F.greatest(F.ceil(F.sum(F.when(own, F.col("w"))) / VALUES), F.ceil(F.count_if(own) / BLOCK))

    cut = staged(held.groupBy("g").agg(blocks(F.lit(True)).alias("nb"), blocks(~F.col("inside")).alias("nc")))

    def cells(df: DataFrame, mine: str, count: str, other: str, counts: str) -> DataFrame:
        return (df.join(cut, "g").withColumn(mine, F.pmod(F.xxhash64("node"), F.col(count)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(counts) - 1)))
                .join(full, "node").select(*[F.col(x).alias(x) for x in ("g", "b", "c", "node", "inside", "_full")]))

    left = cells(all_, "b", "nb", "c", "nc")
    right = cells(all_.filter(~F.col("inside")), "c", "nc", "b", "nb")

    def forest(key, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out, parent = [], {}

        def root(n):
            while parent.setdefault(n, n) != n:
                parent[n] = parent[parent[n]]
                n = parent[n]
            return n

        if len(x) and len(y):
            values, size = flat(x["_full"].to_list())
            of = np.repeat(np.arange(len(x)), size)
            nodes, inside = x["node"].tolist(), x["inside"].tolist()
            order = np.argsort(values, kind="stable")
            values, of = values[order], of[order]
            others, many = flat(y["_full"].to_list())
            first, often = np.searchsorted(values, others), np.searchsorted(values, others, "right")
            often -= first
            ends = np.cumsum(many)
            for node, k, end in zip(y["node"].tolist(), many.tolist(), ends.tolist()):
                both = np.bincount(of[ragged(first[end - k: end], often[end - k: end])], minlength=len(x))
                for i in np.flatnonzero(100 * both >= percent * (size + k - both)).tolist():
                    p, q = root(node), root("inside" if inside[i] else nodes[i])
                    if p != q:
                        parent[p] = q
                        out.append((min(node, nodes[i]), max(node, nodes[i])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return staged(left.groupBy("g", "b", "c").cogroup(right.groupBy("g", "b", "c")).applyInPandas(forest, "a long, b long"))
