"""Merkle manifest of a table: nested-interval labels, containment joins, sibling differences.

A leaf is the digest of a row's fields.  Leaves of a group are ranked, and every
node carries the interval [lo, hi) of leaf ranks that it covers; ``fanout``
consecutive nodes become one until one is left, the group's subroot.  Subroots,
in the order of their groups, make a tree of their own with the root on top.

Levels are built in stripes of a few levels: the nodes below one ancestor (at
most ``STRIPE`` units) meet in one group and their levels are computed there, so
a tree of n leaves takes log n / log STRIPE shuffles, each of 1/STRIPE of the
last one's rows.  Going down again, a stripe joins the stripe above it on the
bucket of that level, where its interval is contained; in every parent on the
way, the intervals that make up the parent's and do not cover the node are its
siblings.  A row's path has them level by level from leaf to root.

Scale: groups are cut by rank, so a group that holds every row is as many
buckets as any other; ranks come from a range partition, not from one task per
group.  A row moves three times as two digests, never with its text.  The
driver sees the largest group's size and the root.

Defined results: leaves of a group ascend by the order column (null first),
equal ones by digest, so repeated rows stand side by side in one tree.  A null
group is a group, before all others; groups follow bytewise.  A null field is
told apart from any value, the empty string included.  An empty table has no
rows and no root.  Columns are read by name, so extra ones can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rank import grouped_row_number
from ..session import drop_stages, stage

STRIPE = 32
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of fields in order: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return digest(*[framed(c) for c in fields])


def _pick(nodes: Column, keep) -> Column:
    """Digests of the nodes that fit, joined in order."""
    return F.array_join(F.transform(F.filter(nodes, keep), lambda q: q["digest"]), "")


def siblings(levels: Column, lo: Column) -> Column:
    """For each level below the last, the siblings (left and right) of the node that covers rank ``lo``."""
    def at(j: Column) -> Column:
        parent = F.element_at(F.filter(F.element_at(levels, j + 1), lambda q: (q["lo"] <= lo) & (lo < q["hi"])), 1)
        inside = F.transform(F.array(parent), lambda p: F.filter(F.element_at(levels, j), lambda q: (q["lo"] >= p["lo"]) & (q["hi"] <= p["hi"])))
        return F.element_at(F.transform(inside, lambda run: F.struct(
            _pick(run, lambda q: q["hi"] <= lo).alias("left"), _pick(run, lambda q: q["lo"] > lo).alias("right"))), 1)
    return F.when(F.size(levels) > 1, F.transform(F.sequence(F.lit(1), F.size(levels) - 1), at)).otherwise(F.array().cast(PATH))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on the path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _levels(units: Column, n: Column, base: int, depth: int, fanout: int) -> Column:
    """Arrays of nodes from the units (at level ``base``) up to the common ancestor, ``depth`` levels at most."""
    def up(nodes: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(nodes), F.lit(fanout)), lambda i: F.slice(nodes, i, fanout))
        return F.transform(runs, lambda run: F.struct(
            F.element_at(run, 1)["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.transform(run, lambda q: q["digest"]), ""), 256).alias("digest")))

    spans = F.array(*[F.lit(fanout ** (base + j)).cast("long") for j in range(depth)])
    return F.aggregate(spans, F.array(units), lambda acc, span: F.when(
        n > span, F.concat(acc, F.array(up(F.element_at(acc, -1))))).otherwise(acc))


@dataclass
class Tree:
    """Stripes of a forest from the leaves up; ``tops`` has (g, digest) of every tree."""

    stripes: list[DataFrame]
    tops: DataFrame
    depth: int
    fanout: int

    def attach(self, above: DataFrame) -> DataFrame:
        """The lowest stripe's rows with ``path``: siblings from its top to the root; above has (g, path)."""
        rows = None
        for k in range(len(self.stripes) - 1, -1, -1):
            own = self.stripes[k].alias("own")
            ends = own.filter("last").join(above.alias("up"), F.col("own.g") == F.col("up.g")).select("own.*", "up.path")
            if rows is None:
                rows = ends
                continue
            # the containing interval of the stripe above: its bucket is that of the level it ends at
            bucket = F.floor(F.col("own.lo") / float(self.fanout ** (self.depth * (k + 2)))).cast("long")
            met = (F.col("own.g") == F.col("up.g")) & (F.col("own.up_bucket") == F.col("up.bucket")) & (
                F.col("up.lo") <= F.col("own.lo")) & (F.col("own.hi") <= F.col("up.hi"))
            inner = own.filter("not last").withColumn("up_bucket", bucket).alias("own").join(rows.alias("up"), met).select(
                *[f"own.{c}" for c in self.stripes[k].columns], F.concat(siblings(F.col("up.levels"), F.col("own.lo")), F.col("up.path")).alias("path"))
            rows = ends.unionByName(inner)
        return rows


def build(units: DataFrame, largest: int, fanout: int, carry: Sequence[str] = ()) -> Tree:
    """Tree of every group g of units (g, lo, hi, n, digest and the ``carry`` columns), n leaves in the group."""
    depth = 1
    while fanout ** (depth + 1) <= STRIPE:
        depth += 1
    stripes, base, payload = [], 0, ["lo", *carry]
    while True:
        span = fanout ** (base + depth)
        bucket = F.floor(F.col("lo") / float(span)).cast("long")
        grouped = units.groupBy("g", "n", bucket.alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("units"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            *([F.collect_list(F.struct(*payload)).alias("members")] if base == 0 else []))
        made = stage(grouped.withColumn("levels", _levels(F.col("units"), F.col("n"), base, depth, fanout)).drop("units")
                     .withColumn("digest", F.element_at(F.element_at("levels", -1), 1)["digest"])
                     .withColumn("last", F.col("n") <= F.lit(span).cast("long")), "stripe")
        stripes.append(made)
        if largest <= span:
            break
        units = made.filter("not last").select("g", "lo", "hi", "n", "digest")
        base += depth
    tops = stripes[0].filter("last").select("g", "digest")
    for s in stripes[1:]:
        tops = tops.unionByName(s.filter("last").select("g", "digest"))
    return Tree(stripes, stage(tops, "subroots"), depth, fanout)


@dataclass
class Manifest:
    """``rows``: order column, group, carried columns, leaf, subroot and path; ``root``: None for an empty table."""

    rows: DataFrame
    root: str | None


def merkle_manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str, carry: dict[str, Column] | None = None,
                    fanout: int = 2) -> Manifest:
    """Leaf, subroot and sibling path of every row; ``carry`` names further expressions that travel with the leaf."""
    if not 2 <= fanout <= STRIPE:
        raise ValueError(f"the fanout must lie in 2..{STRIPE}")
    col = lambda c: F.col(f"`{c}`")
    carry = carry or {}
    key = F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit(""))  # null before all others
    narrow = stage(docs.select(key.alias("g"), col(order).alias("at"), leaf_digest([col(c) for c in fields]).alias("digest"),
                               *[e.alias(f"c{i}") for i, e in enumerate(carry.values())],
                               F.monotonically_increasing_id().alias("rid")), "leaves")
    kept = [f"c{i}" for i in range(len(carry))]
    types = dict(docs.select(col(order), col(group)).dtypes)
    ranked = stage(grouped_row_number(narrow, ["at", "digest", "rid"], ["g"], "rank", "n").select(
        "g", "n", (F.col("rank") - 1).alias("lo"), F.col("rank").alias("hi"), "digest", "at", *kept), "ranked")
    largest = ranked.agg(F.max("n")).first()[0]
    if largest is None:
        rows = narrow.select("at", "g", *kept, F.col("digest").alias("leaf"), F.col("digest").alias("subroot"), F.array().cast(PATH).alias("path"))
        return Manifest(_named(rows, order, group, types, carry), None)
    below = build(ranked, largest, fanout, ["at", "digest", *kept])
    order_of = grouped_row_number(below.tops, ["g"], (), "rank", "n")
    upper_units = stage(order_of.select(F.lit("").alias("g"), F.col("n").cast("long").alias("n"), (F.col("rank") - 1).alias("lo"),
                                        F.col("rank").alias("hi"), "digest", F.col("g").alias("of")), "subroots")
    above = build(upper_units, upper_units.agg(F.max("n")).first()[0], fanout, ["of", "digest"])
    root = above.tops.first()["digest"]
    no_path = above.tops.select("g", F.array().cast(PATH).alias("path"))
    subroots = above.attach(no_path).select("levels", "path", F.explode("members").alias("m")).select(
        F.col("m.of").alias("g"), F.col("m.digest").alias("subroot"), F.concat(siblings(F.col("levels"), F.col("m.lo")), F.col("path")).alias("path"))
    subroots = stage(subroots, "subroot-paths")
    attached = below.attach(subroots.select("g", "path"))
    member = lambda m: F.struct(
        m["at"].alias("at"), *[m[c].alias(c) for c in kept], m["digest"].alias("leaf"), F.concat(siblings(F.col("levels"), m["lo"]), F.col("path")).alias("path"))
    leaves = attached.select("g", F.explode(F.transform("members", member)).alias("m")).select("g", "m.*")
    rows = leaves.join(subroots.select("g", "subroot"), "g").select("at", "g", *kept, "leaf", "subroot", "path")
    drop_stages(narrow, ranked)
    return Manifest(_named(rows, order, group, types, carry), root)


def _named(rows: DataFrame, order: str, group: str, types: dict, carry: dict) -> DataFrame:
    own = F.when(F.col("g") != "", F.expr("substr(g, 2)")).cast(types[group])
    return rows.select(F.col("at").alias(order), own.alias(group), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "leaf", "subroot", "path")
