"""Merkle manifest of a table: a tree of arity three over the rows of each group, one over the groups.

Every node carries the closed interval of leaf ranks that it covers. Intervals of one level never
cross a bucket of that level's width, so a node's ancestors are found by joins on (group, bucket of
the level) with a containment condition, and its siblings are what is left of the parent's interval
without its own.

Trees are built in bands of ``BAND`` levels. A band's bucket (at most 3^BAND nodes, whatever the
size of the group) holds its nodes and the levels above them up to one root, computed in one row; the
roots are the nodes of the next band. A proof is put together from the top: the path above a bucket
comes to it by one containment join, so paths are attached once per bucket and not to every leaf.
A group with most rows is as many buckets as any other rows would be.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import fresh
from footfall.session import staged, staging

ARITY = 3
#: Levels of a band: a bucket has at most 3^5 = 243 nodes.
BAND = 5
#: What stands for a missing value and between its length and a value.
MISSING, COLON = "-", ":"

Stage = Callable[[DataFrame, str], DataFrame]


def framed(value: Column) -> Column:
    """A value as its UTF-8 length, a colon and its text; a missing one as ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(COLON), text), F.lit(MISSING))


def row_digest(*values: Column) -> Column:
    """SHA-256 in lowercase hex of all values, each framed so that no two rows run together alike."""
    return F.sha2(F.concat(*(framed(v) for v in values)), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda c: c["digest"]), "")


def _group_key(group: str) -> Column:
    """Never null, and in the order of the groups: the null group first, the others bytewise."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("g")


def ranked(leaves: DataFrame, stage: Stage) -> DataFrame:
    """``lo`` (0, 1, ... within ``g``) and ``n`` (leaves of ``g``), by ``ord``, then by digest.

    Rows are dealt by ranges of the order, so a group is spread over tasks; a row's rank is its place
    in its task plus the rows of its group in earlier tasks, of which there is one count per task and
    group.
    """
    order = [F.col("g"), F.col("ord").asc_nulls_first(), F.col("digest")]
    dealt = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(
        dealt.select("*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place")), "ordered"
    )
    counts = placed.groupBy("g", "task").agg(F.count(F.lit(1)).alias("here"), F.min("place").alias("first"))
    earlier = Window.partitionBy("g").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "g", "task",
        (F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(Window.partitionBy("g")).alias("n"),
    )
    lo = F.col("place") + F.col("shift")
    return placed.join(starts, ["g", "task"]).select("g", "n", lo.alias("lo"), lo.alias("hi"), "digest", "payload")


def _parents(nodes: Column) -> Column:
    """The level above: one node for every three, the last one for what is left."""
    def parent(p: Column) -> Column:
        run = F.slice(nodes, p * ARITY + 1, ARITY)
        return F.struct(
            F.element_at(run, 1)["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
            F.sha2(_joined(run), 256).alias("digest"),
        )

    last = F.floor((F.size(nodes) - 1) / ARITY).cast("int")
    return F.transform(F.sequence(F.lit(0), last), parent)


def _band(nodes: DataFrame, low_width: int) -> DataFrame:
    """Buckets of nodes that each cover ``low_width`` leaves: ``kids`` and ``levels``, the kids' first.

    The bucket that holds a whole group stops at its root; all others have ``BAND`` levels above
    their kids, also where a run is a single node.
    """
    width = low_width * ARITY**BAND
    kid = F.struct("lo", "hi", "digest", "payload")
    buckets = nodes.groupBy("g", "n", F.expr(f"lo div {width}").alias("bucket")).agg(
        F.sort_array(F.collect_list(kid)).alias("kids")
    )
    steps = F.when(F.col("n") <= low_width, 0)
    for k in range(1, BAND):
        steps = steps.when(F.col("n") <= low_width * ARITY**k, k)
    base = F.transform("kids", lambda c: F.struct(c["lo"].alias("lo"), c["hi"].alias("hi"), c["digest"].alias("digest")))
    levels = F.aggregate(
        F.slice(F.sequence(F.lit(1), F.lit(BAND)), F.lit(1), steps.otherwise(BAND)),
        F.array(base),
        lambda found, _: F.concat(found, F.array(_parents(F.element_at(found, -1)))),
    )
    return buckets.select("g", "n", "bucket", "kids", levels.alias("levels"))


@dataclass
class Tree:
    """Bands from the leaves up, with the leaves that a kid of each covers, and the root of every group."""

    bands: list[tuple[int, DataFrame]]
    roots: DataFrame  # g, n, digest


def build_tree(leaves: DataFrame, stage: Stage) -> Tree:
    """Trees over ``g, ord, digest, payload``, one per group; every band is stored."""
    nodes = ranked(leaves, stage)
    bands, roots, width = [], None, 1
    while True:
        band = stage(_band(nodes, width), "band")
        bands.append((width, band))
        width *= ARITY**BAND
        top = F.element_at(F.element_at("levels", -1), 1)
        tops = band.select("g", "n", top["lo"].alias("lo"), top["hi"].alias("hi"), top["digest"].alias("digest"))
        done = tops.where(F.col("n") <= width).select("g", "n", "digest")
        roots = done if roots is None else roots.unionByName(done)
        if band.where(F.col("n") > width).isEmpty():
            return Tree(bands, stage(roots, "roots"))
        payload = F.lit(None).cast(nodes.schema["payload"].dataType)
        nodes = tops.where(F.col("n") > width).withColumn("payload", payload)


def _paths(band: DataFrame) -> DataFrame:
    """``proven``: every kid with its path, the siblings at each level up to the bucket's root and above.

    At a level a node's siblings are the nodes of its parent's interval outside its own, to its
    left and to its right.
    """
    powers = F.array(*(F.lit(ARITY**j) for j in range(BAND + 1)))

    def step(i: Column, kid: Column, j: Column) -> Column:
        parent = F.floor(i / F.element_at(powers, j + 2)).cast("int")
        run = F.slice(F.element_at("levels", j + 1), parent * ARITY + 1, ARITY)
        return F.struct(
            _joined(F.filter(run, lambda c: c["hi"] < kid["lo"])).alias("left"),
            _joined(F.filter(run, lambda c: c["lo"] > kid["hi"])).alias("right"),
        )

    def proven(kid: Column, i: Column) -> Column:
        steps = F.slice(F.sequence(F.lit(0), F.lit(BAND - 1)), F.lit(1), F.size("levels") - 1)
        path = F.concat(F.transform(steps, lambda j: step(i, kid, j)), F.col("above"))
        return F.struct(kid.alias("kid"), path.alias("path"))

    return band.select("g", "subroot", "root", F.transform("kids", proven).alias("proven"))


def _proven_leaves(tree: Tree, tops: DataFrame) -> DataFrame:
    """Buckets of the lowest band with the paths of their leaves up to the root of all.

    ``tops`` (g, lo, hi, above, subroot, root) has the path above each group's root.
    """
    names = ["g", "lo", "hi", "above", "subroot", "root"]
    above = tops.select(*names)
    for low_width, band in reversed(tree.bands):
        width = low_width * ARITY**BAND
        first, last = F.element_at("kids", 1)["lo"], F.element_at("kids", -1)["hi"]
        holder = above.select(
            F.col("g").alias("of"), F.expr(f"lo div {width}").alias("slot"), *(F.col(c) for c in names[1:])
        )
        contained = (
            (F.col("g") == F.col("of")) & (F.col("bucket") == F.col("slot"))
            & (F.col("lo") <= first) & (last <= F.col("hi"))
        )
        paths = _paths(band.join(holder, contained))
        if low_width == 1:
            return paths
        each = paths.select("g", "subroot", "root", F.explode("proven").alias("p"))
        lower = each.select(
            "g", F.col("p.kid.lo").alias("lo"), F.col("p.kid.hi").alias("hi"), F.col("p.path").alias("above"),
            "subroot", "root",
        )
        # groups that end in a lower band get the path above their root there
        above = tops.where(F.col("hi") < low_width).select(*names).unionByName(lower.select(*names))
    raise AssertionError("a tree has a lowest band")


RESULTS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "path")
NO_PATH = "array<struct<left:string,right:string>>"


def manifest(
    docs: DataFrame, group: str, order: str, digest: Column, claimed: Column, keep: tuple[str, ...] = (),
    with_paths: bool = False,
) -> DataFrame:
    """The place of every row in the manifest: ``keep``, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``digest`` is a row's leaf. Leaves of a group stand in order of ``order`` (nulls first, ties by
    digest, so equal rows are equal leaves side by side); group roots in order of ``group`` (null
    first, then bytewise). A proof is the digests of the siblings from the leaf up to the root, left
    to right at each level; ``with_paths`` adds them as ``path`` (array of left and right per level).
    ``folded_root`` folds ``claimed``, a digest of what is now held as the row, through the original
    siblings; ``verified`` is whether it gives the root. A null ``claimed`` digest is not verified and
    folds to null. A table of one row has an empty proof and its leaf as root; an empty table gives
    an empty result. Columns of ``keep`` with the results' names are replaced; columns beyond take no part.
    """
    spark = docs.sparkSession
    keep = tuple(c for c in keep if c.lower() not in RESULTS)
    held = fresh("claimed", list(keep))
    leaves = docs.select(
        _group_key(group), F.col(f"`{order}`").alias("ord"), digest.alias("digest"),
        F.struct(*(F.col(f"`{c}`") for c in keep), claimed.alias(held)).alias("payload"),
    )
    with staging(spark) as stage:
        tree = build_tree(leaves, stage)
        of_groups = build_tree(
            tree.roots.select(F.lit("").alias("g"), F.col("g").alias("ord"), "digest", F.struct("g", "n").alias("payload")),
            stage,
        )
        whole = of_groups.roots.select(
            "g", F.lit(0).cast("long").alias("lo"), (F.col("n") - 1).alias("hi"),
            F.array().cast(NO_PATH).alias("above"), F.col("digest").alias("subroot"), F.col("digest").alias("root"),
        )
        group_paths = _proven_leaves(of_groups, whole).select("root", F.explode("proven").alias("p"))
        tops = stage(
            group_paths.select(
                F.col("p.kid.payload.g").alias("g"), F.lit(0).cast("long").alias("lo"),
                (F.col("p.kid.payload.n") - 1).alias("hi"), F.col("p.path").alias("above"),
                F.col("p.kid.digest").alias("subroot"), "root",
            ),
            "tops",
        )

        def folded(p: Column) -> Column:
            return F.aggregate(
                p["path"], p["kid"]["payload"][held],
                lambda below, at: F.sha2(F.concat(at["left"], below, at["right"]), 256),
            )

        def answer(p: Column) -> Column:
            siblings = F.array_join(F.transform(p["path"], lambda at: F.concat(at["left"], at["right"])), "")
            columns = [
                p["kid"]["payload"].alias("row"), p["kid"]["digest"].alias("leaf"),
                F.sha2(siblings, 256).alias("proof_sha256"), folded(p).alias("folded_root"),
            ]
            return F.struct(*columns, *([p["path"].alias("path")] if with_paths else []))

        answered = _proven_leaves(tree, tops).select("subroot", "root", F.explode(F.transform("proven", answer)).alias("a"))
        result = answered.select(
            *(F.col(f"a.row.`{c}`").alias(c) for c in keep), F.col("a.leaf").alias("leaf"), "subroot", "root",
            F.col("a.proof_sha256").alias("proof_sha256"), F.col("a.folded_root").alias("folded_root"),
            F.coalesce(F.col("a.folded_root") == F.col("root"), F.lit(False)).alias("verified"),
            *([F.col("a.path").alias("path")] if with_paths else []),
        )
        return staged(result, "manifest")


def manifest_nodes(docs: DataFrame, group: str, order: str, digest: Column) -> DataFrame:
    """All nodes of the group trees: ``name`` (null for the null group), ``level, lo, hi, digest``.

    Levels count from the leaves (0). What is needed to keep a manifest or to compare two of them
    from the roots down.
    """
    leaves = docs.select(
        _group_key(group), F.col(f"`{order}`").alias("ord"), digest.alias("digest"),
        F.struct(F.lit(None).cast("boolean").alias("none")).alias("payload"),
    )
    with staging(docs.sparkSession) as stage:
        parts = []
        for at, (_, band) in enumerate(build_tree(leaves, stage).bands):
            levels = band.select("g", F.posexplode("levels").alias("j", "nodes"))
            # the root of a bucket is a kid of the next band
            own = levels.where(F.col("j") < BAND) if at == 0 else levels.where((F.col("j") > 0) & (F.col("j") < BAND))
            parts.append(own.select("g", (F.col("j") + at * BAND).alias("level"), F.inline("nodes")))
            tops = levels.where(F.col("j") == BAND)
            parts.append(tops.select("g", (F.col("j") + at * BAND).alias("level"), F.inline("nodes")))
        nodes = parts[0]
        for part in parts[1:]:
            nodes = nodes.unionByName(part)
        name = F.when(F.col("g") != "", F.substring(F.col("g"), 2, 1 << 30))
        return staged(nodes.select(name.alias("name"), "level", "lo", "hi", "digest"), "nodes")
