"""Connected components, and links inside blocks without all pairs of a block.

``components`` alternates the large-star and small-star steps on an edge table
until no edge changes; each step is a grouped minimum and a join, and every
round is written to the shared folder.

``link_blocks`` finds the components of the links between members of common
blocks.  First each member is compared with its block's first member only; a
block whose members are then all connected needs nothing more, so a block of n
near copies costs n comparisons.  In the other blocks, members outside the
largest component are compared with a few random members of it, which connects
most of what a single centre misses, and at last members of different
components are compared, those outside the block's largest component with all.
No pair of different components that shares a block goes uncompared, so the
components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklens.llm.shared import dropped, written


#: Members of a block's largest component that the others are compared with before all are.
CENTRES = 4


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of any comparable ids -> (id, component): the smallest id reachable, for every id with an edge."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        before, now = now, written(_small_star(_large_star(now)), "edges")
        dropped(before)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def link_blocks(blocks: DataFrame, verify: Callable[[DataFrame], DataFrame], carry: tuple[str, ...] = (), fits: str = "true", first: str = "id", sides: tuple[str, ...] = (), rounds: int = 1, carried: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(id, component) of the ids that a verified link joins with another.

    ``blocks``: (key, id, carried columns).  ``fits``: an SQL condition on a
    pair's carried columns, with the prefixes a_ and b_, that every link meets
    in at least one of its blocks.  ``verify`` takes pairs (a, b, and the
    carried columns ``sides`` with these prefixes), each once, and returns the
    linked (a, b).  ``first``: the column whose least value marks the first
    member of a block.  ``rounds``: the blocks are gone through in as many parts,
    by their key, one after the other.  ``carried`` adds the carried columns to
    rows of ``blocks`` that don't have them.
    """
    cols = ["id", *carry]
    keyed = Window.partitionBy("key")

    def linked(found: Iterator[DataFrame]) -> list[DataFrame]:
        """The links of the pairs of all parts; parts only leave their pairs, which are compared together."""
        fit = (pairs.where(fits).select("a", "b", *(f"{s}_{c}" for c in sides for s in "ab")).distinct() for pairs in found)
        if rounds == 1:
            return [written(verify(pairs).select("a", "b"), "links") for pairs in fit]
        kept = [written(pairs, "pairs") for pairs in fit]
        links = written(verify(reduce(DataFrame.unionByName, kept).distinct()).select("a", "b"), "links")
        dropped(*kept)
        return [links]

    full = carried or (lambda rows: rows)
    parts = [blocks.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == i) if rounds > 1 else blocks for i in range(rounds)]

    def sided(rows: DataFrame, a: str) -> DataFrame:
        """Pairs of a block's member in column ``a`` and the row's own."""
        return rows.select(*(F.col(f"{a}.{c}").alias("a" if c == "id" else f"a_{c}") for c in cols), *(F.col(c).alias("b" if c == "id" else f"b_{c}") for c in cols))

    def star(part: DataFrame) -> DataFrame:
        low = F.min(F.struct(F.col(first).alias("_first"), *cols)).over(keyed)
        return sided(full(part).withColumn("low", low).where("low.id <> id"), "low")

    def again(part: DataFrame) -> DataFrame:
        main = [F.when(F.col("component") == F.col("main"), F.struct(F.xxhash64("id", F.lit(i)), *cols)) for i in range(CENTRES)]
        centre = _mixed(full(part), known).withColumns({f"_c{i}": F.min(m).over(keyed) for i, m in enumerate(main)}).where("component <> main")
        return sided(centre.withColumn("centre", F.explode(F.array(*(f"_c{i}" for i in range(CENTRES))))), "centre")

    def across() -> Iterator[DataFrame]:
        for part in parts:
            held = written(_mixed(full(part), known), "mixed")
            left = held.where("component <> main").select("key", F.col("component").alias("a_component"), *(F.col(c).alias("a" if c == "id" else f"a_{c}") for c in cols))
            right = held.select("key", F.col("component").alias("b_component"), "main", *(F.col(c).alias("b" if c == "id" else f"b_{c}") for c in cols))
            yield left.join(right, "key").where("a_component <> b_component and (b_component = main or a < b)")
            dropped(held)

    links = linked(map(star, parts))
    known = components(reduce(DataFrame.unionByName, links))
    links += linked(map(again, parts))
    known = components(reduce(DataFrame.unionByName, links))
    more = linked(across())
    return known if all(x.isEmpty() for x in more) else components(reduce(DataFrame.unionByName, links + more))


def _mixed(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """The blocks with members of several components, with every member's component and the block's largest (main)."""
    keyed = Window.partitionBy("key")
    held = blocks.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    # counted before the others go, so one order of the rows serves all windows
    held = held.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key", "component")))
    held = held.withColumn("mixed", F.min("component").over(keyed) != F.max("component").over(keyed)).where("mixed").drop("mixed")
    return held.withColumn("main", F.max(F.struct("members", "component")).over(keyed)["component"]).drop("members")
