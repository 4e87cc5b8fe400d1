"""Links to components, and bounded lists of equal keys.

``components`` turns links into the smallest id reachable, by alternating
large-star and small-star steps over the links as a table. ``groups`` deals the
members of each key into lists of bounded size such that any two members of a
key meet in some list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm import util

#: Copies of a node's minimum that its links are spread over (a node may hold a third of all links).
SALT = 16


def _step(links: DataFrame, keep) -> DataFrame:
    """Each node's smallest neighbour (itself included), brought to all its links."""
    least = links.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
    least = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = links.withColumn("s", F.pmod(F.xxhash64("y"), F.lit(SALT)).cast("int"))
    return salted.join(least, ["x", "s"]).where(keep)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b) of bigint ids; component is the smallest id reachable.

    Nodes without a link to another node are not returned. Null ids are ignored.
    The steps repeat until the links no longer change (about the logarithm of
    the longest path); each is cut by a reliable checkpoint.
    """
    e = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
        .distinct()
    )
    e = util.cut(e)
    state = None
    while True:
        both = e.union(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        large = _step(both, F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        # y > x and m <= x, so every link still points from the larger to the smaller id
        hung = large.groupBy("x").agg(F.min("y").alias("m"))
        small = (
            _step(large, F.col("y") <= F.col("x"))
            .where("y <> m")
            .select(F.col("y").alias("x"), F.col("m").alias("y"))
            .union(hung.select("x", F.col("m").alias("y")))
            .distinct()
        )
        e = util.cut(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("y").alias("node")).distinct()
    return e.select(F.col("x").alias("node"), F.col("y").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def groups(members: DataFrame, key: str, member: str, size: int, value: Column) -> DataFrame:
    """(key, gi, gj, members): lists of ``value`` in which any two members of a key meet; lists of one are left out.

    A key of up to ``size`` members is one list. The members of a larger key
    are dealt over blocks of about ``size`` (column ``block``, which ``value``
    may hold); every pair of blocks is a list of at most about twice ``size``.
    Only the crowded keys are looked up, so nothing is made for each chance
    meeting of two members.
    """
    n = members.groupBy(key).agg(F.count("*").alias("__n"))
    crowded = util.stored(n.where(F.col("__n") > size), "crowded-keys")
    zero = F.lit(0)
    plain = members.join(crowded, key, "left_anti").withColumns({"block": zero, "gi": zero, "gj": zero})
    dealt = (
        members.join(crowded, key)
        .withColumn("__nb", F.ceil(F.col("__n") / size).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64(member, F.lit(7)), F.col("__nb")).cast("int"))
        .withColumn("__o", F.explode(F.sequence(zero, F.col("__nb") - 1)))
        .withColumns({"gi": F.least("block", "__o"), "gj": F.greatest("block", "__o")})
    )
    listed = F.collect_list(value).alias("members")
    small = plain.groupBy(key).agg(listed).select(key, zero.alias("gi"), zero.alias("gj"), "members")
    large = dealt.groupBy(key, "gi", "gj").agg(listed)
    return small.union(large).where(F.size("members") > 1)
