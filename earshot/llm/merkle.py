"""Merkle manifest of a table: trees per language under one root, proofs by a recursive climb over stored nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.session import broadcast_if_small, materialize

# Nodes hashed together in one row while levels are built: ten levels at a time.
RUN_LEVELS = 10
# Levels that one step of the climb ascends: a node's row names the node so far above it and the siblings on the way.
STRIDE = 5
# A node with more than one part in so many of all leaves below it is broad. No level has more broad nodes than that,
# and no other node has more leaves.
SHARES = 8192
TAMPER_EVERY = 7
# The tree over the subroots.
UPPER = -1


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _parent(left: Column, right: Column) -> Column:
    return _digest(_hex(left), F.coalesce(_hex(right), F.lit("")))


def field(value: Column) -> Column:
    """A field of a leaf: byte count, colon, value; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves_of(docs: DataFrame, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """doc_id, lang, leaf and tampered: digests of doc_id, source, lang, n_chars and text.

    tampered is the leaf with n_chars + 1 where tamper_every divides the crc32 of the decimal doc_id, else the leaf; a null
    n_chars or doc_id leaves it as it is. Null fields count as `-`, an empty text as `0:`.
    """
    def leaf(n_chars: Column) -> Column:
        return _digest(*(field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))))

    chosen = F.crc32(F.col("doc_id").cast("string")) % tamper_every == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    plain = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"),
                        F.when(chosen & F.col("n_chars").isNotNull(), leaf(more)).alias("changed"))
    return plain.select("doc_id", "lang", "leaf", F.coalesce("changed", "leaf").alias("tampered"))


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with row, a number of each row, and pos, its place (from 0) in the order of its tree.

    Rows are range-sorted by tree and order; a place is that in the partition plus the rows of the tree in the
    partitions before, so no tree is one task's, however large. Equal keys are told apart by the row's number.
    """
    numbered = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    keys = [F.col(c) for c in (tree, *order, "row")]
    ranged = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_at", 33)
    parts = at.groupBy(F.col(tree).alias("_tree"), part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = F.sum("_rows").over(W.partitionBy("_tree").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = parts.select("_tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = at.join(broadcast_if_small(starts), F.col(tree).eqNullSafe(F.col("_tree")) & (part == F.col("_part")))
    return joined.select(*rows.columns, "row", (F.col("_at") + F.col("_shift")).alias("pos"))


def _climbed_runs(level: DataFrame) -> DataFrame:
    """RUN_LEVELS levels built above the given one: the nodes that steps start from, and the last of each run (top).

    level: tree, level, pos, digest, below and size, the tree's nodes on that level. A tree of one run ends at its single
    node; in others every run is climbed equally far, its last one too. Steps start from every STRIDE-th level; path holds
    the siblings met by one step, left or right ones, neither where an odd node stands alone.
    """
    rows = level.groupBy("tree", "level", "size", F.shiftright("pos", RUN_LEVELS).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "below"))).alias("n0"))
    empty = F.array().cast("array<struct<pos:bigint,digest:binary,below:bigint>>")
    whole = F.col("size") <= 1 << RUN_LEVELS
    for k in range(RUN_LEVELS):
        def above(i: Column, of: str = f"n{k}") -> Column:
            left, right = F.get(of, 2 * i), F.get(of, 2 * i + 1)
            return F.struct(F.shiftright(left["pos"], 1).alias("pos"), _parent(left["digest"], right["digest"]).alias("digest"),
                            (left["below"] + F.coalesce(right["below"], F.lit(0))).alias("below"))

        count = F.size(f"n{k}")
        made = F.transform(F.sequence(F.lit(0), F.shiftright(count - 1, 1)), lambda i: above(i))
        # inline works a level out once; as an expression it would be copied into the next.
        rows = rows.select("*", F.inline(F.array(F.struct(
            F.when((count > 1) | (~whole & (count > 0)), made).otherwise(empty).alias(f"n{k + 1}")))))

    def row(k: int, node: Column, path: Column, up_below: Column, top: bool) -> Column:
        return F.struct((F.col("level") + k).alias("level"), node["pos"].alias("pos"), node["digest"].alias("digest"),
                        node["below"].alias("below"), path.alias("path"), up_below.alias("up_below"), F.lit(top).alias("top"))

    def steps(k: int) -> Column:
        def one(node: Column, i: Column) -> Column:
            met, over = [], []
            for j in range(k, k + STRIDE):
                at = F.shiftright(i, j - k)
                parent = F.get(f"n{j + 1}", F.shiftright(at, 1))
                over.insert(0, parent["below"])
                met.append(F.when(parent.isNotNull(), F.struct(
                    F.when(at % 2 == 1, F.get(f"n{j}", at - 1)["digest"]).alias("left"),
                    F.when(at % 2 == 0, F.get(f"n{j}", at + 1)["digest"]).alias("right"))))
            return row(k, node, F.array_compact(F.array(*met)), F.coalesce(*over), False)

        return F.when(F.size(f"n{k + 1}") > 0, F.transform(f"n{k}", one))

    def tops(k: int) -> Column:
        no_path = F.array().cast("array<struct<left:binary,right:binary>>")
        last = F.transform(f"n{k}", lambda node: row(k, node, no_path, F.lit(None).cast("long"), True))
        return F.when(F.size(f"n{k + 1}") == 0, last) if k < RUN_LEVELS else last

    parts = F.array(*(steps(k) for k in range(0, RUN_LEVELS, STRIDE)), *(tops(k) for k in range(RUN_LEVELS + 1)))
    return rows.select("tree", whole.alias("ended"), F.explode(parts).alias("made")).select("tree", "ended", F.inline("made"))


def built(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes that steps start from (tree, level, pos, digest, below, path, up_level, up_pos, up_below), and the last node of every tree.

    leaves: tree, pos, digest and below, the leaves of the whole manifest under each.
    """
    level, nodes, tops = leaves.withColumn("level", F.lit(0)), [], []
    while level is not None:
        sizes = level.groupBy(F.col("tree").alias("_tree")).agg((F.max("pos") + 1).alias("size"))
        made = materialize(_climbed_runs(level.join(broadcast_if_small(sizes), F.col("tree") == F.col("_tree"))), "levels")
        nodes.append(made.where("NOT top").selectExpr(
            "tree", "level", "pos", "digest", "below", "path", "level + size(path) AS up_level",
            "shiftright(pos, size(path)) AS up_pos", "up_below"))
        tops.append(made.where("top AND ended").select("tree", F.col("level").alias("height"), "digest", "below"))
        level = made.where("top AND NOT ended").select("tree", "level", "pos", "digest", "below")
        level = None if level.isEmpty() else level
    return _union(nodes), _union(tops)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


CLIMB = """
WITH RECURSIVE climb AS (
  SELECT row, step, doc_id, leaf, folded, path, subroot, root, up_tree, up_level, up_pos, up_broad FROM {start}
  UNION ALL
  SELECT HINT c.row, c.step + 1 AS step, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS BINARY) AS leaf,
         aggregate(c.path, c.folded, (h, s) -> unhex(sha2(CAST(
             concat(coalesce(lower(hex(s.left)), ''), lower(hex(h)), coalesce(lower(hex(s.right)), '')) AS BINARY), 256))) AS folded,
         n.path, n.subroot, n.root, n.up_tree, n.up_level, n.up_pos, n.up_broad
  FROM climb c JOIN {nodes} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos
)
SELECT * FROM climb
"""


def _climb(start: DataFrame, nodes: DataFrame, broad: bool) -> DataFrame:
    """Every step from the start rows upwards, as far as the nodes go."""
    return start.sparkSession.sql(CLIMB.replace("HINT", "/*+ BROADCAST(n) */" if broad else "/*+ MERGE(n) */"), start=start, nodes=nodes)


def node_table(leaves: DataFrame, total: int) -> DataFrame:
    """Stored nodes (tree, level, pos) that steps start from, with the node each leads to; the last node leads nowhere.

    leaves: tree, pos, digest, total of them. A tree's last node is that leaf of the upper tree whose pos is the tree's
    number. subroot and root hold the digests of such nodes; broad and up_broad tell nodes and aims that are broad.
    """
    nodes, tops = built(leaves.withColumn("below", F.lit(1).cast("long")))
    lower = nodes.join(broadcast_if_small(tops.select(F.col("tree").alias("_tree"), "height")), F.col("tree") == F.col("_tree"))
    inside = F.col("up_level") < F.col("height")
    no_digest, top_tree = F.lit(None).cast("binary"), F.lit(UPPER).cast("long")
    broad, up_broad = ((F.col(c) * SHARES > total).alias(n) for c, n in (("below", "broad"), ("up_below", "up_broad")))
    lower = lower.select(
        "tree", "level", "pos", "path", no_digest.alias("subroot"), no_digest.alias("root"), "below", broad,
        F.when(inside, F.col("tree")).otherwise(top_tree).alias("up_tree"), F.when(inside, F.col("up_level")).otherwise(0).alias("up_level"),
        F.when(inside, F.col("up_pos")).otherwise(F.col("tree")).alias("up_pos"), up_broad)

    nodes, last = built(tops.select(top_tree.alias("tree"), F.col("tree").alias("pos"), "digest", "below"))
    subroot = F.when(F.col("level") == 0, F.col("digest")).alias("subroot")
    upper = nodes.select("tree", "level", "pos", "path", subroot, no_digest.alias("root"), "below", broad,
                         top_tree.alias("up_tree"), "up_level", "up_pos", up_broad)
    last = last.withColumnRenamed("height", "level").select(
        "tree", "level", F.lit(0).cast("long").alias("pos"), F.array().cast("array<struct<left:binary,right:binary>>").alias("path"),
        subroot, F.col("digest").alias("root"), "below", broad, F.lit(None).cast("long").alias("up_tree"),
        F.lit(None).cast("int").alias("up_level"), F.lit(None).cast("long").alias("up_pos"), F.lit(False).alias("up_broad"))
    return materialize(lower.union(upper).union(last), "nodes")


def climbed(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """The path of every leaf: one row per step, from the leaf to the root.

    start: row, doc_id, leaf, tampered, tree, pos. First up to the broad nodes by a join on keys, then on through these,
    which are broadcast. Steps are counted from the leaf.
    """
    in_lower = F.col("tree") >= 0
    own = nodes.where("level = 0 AND (tree >= 0 OR below = 1)").select(
        F.when(in_lower, F.col("tree")).otherwise(F.col("pos")).alias("tree"), F.when(in_lower, F.col("pos")).otherwise(0).alias("pos"),
        "path", "subroot", "root", "up_tree", "up_level", "up_pos", "up_broad")
    begun = start.withColumnRenamed("tampered", "folded").withColumn("step", F.lit(0)).join(own, ["tree", "pos"])
    low = materialize(_climb(begun, nodes.where("NOT broad"), broad=False), "climb")
    high = _climb(low.where("up_broad"), nodes.where("broad"), broad=True)
    return low.where("NOT up_broad").union(high)


def merkle_manifest(leaves: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, one row per leaf, digests in lower-case hex.

    leaves: doc_id, lang, leaf and tampered (see leaves_of). Leaves of one lang ascend by doc_id (null first; equal ones by
    leaf); every two consecutive nodes of a level are hashed to one of the next, an odd last node alone, until one is left.
    The subroots, null lang first, then by bytes, form the upper tree in the same way.

    Levels are built from runs of 1,024 nodes, so neither a language nor a level is one task's, and stored as rows that
    name the node above and the siblings on the way. A recursive query climbs for every leaf at once: each step folds
    the tampered hash with the siblings of its node, joins the row above and appends that row's siblings. A step ascends
    up to STRIDE levels, so that fewer rows are shuffled. It stops below broad nodes, whose number is bounded; these are
    broadcast to a second recursive query that goes on from there. So no node draws its leaves to one task.

    Rows that repeat a doc_id are leaves of their own. Other columns are not read; an empty table gives no row.
    """
    spark = leaves.sparkSession
    ranked = placed(leaves.select("doc_id", "lang", "leaf", "tampered"), "lang", ["doc_id", "leaf"])
    langs = ranked.select("lang").distinct().withColumn("all", F.lit(0))
    # Trees are numbered in the order of their languages.
    trees = materialize(placed(langs, "all", ["lang"]).select(F.col("lang").alias("_lang"), F.col("pos").alias("tree")), "trees")
    based = materialize(ranked.join(broadcast_if_small(trees), F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "row", "doc_id", "leaf", "tampered", "tree", "pos"), "leaves")
    nodes = node_table(based.select("tree", "pos", F.col("leaf").alias("digest")), based.count())

    limit = "spark.sql.cteRecursionRowLimit"  # the rows of a climb grow with the table
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        paths = climbed(based, nodes).groupBy("row").agg(
            *(F.max(c).alias(c) for c in ("doc_id", "leaf", "subroot", "root")),
            F.max(F.when(F.col("root").isNotNull(), F.col("folded"))).alias("folded_root"),
            F.array_sort(F.collect_list(F.struct("step", "path"))).alias("steps"))
        met = F.flatten(F.transform("steps", lambda s: s["path"]))
        proof = F.array_join(F.transform(met, lambda s: F.coalesce(_hex(s["left"]), _hex(s["right"]), F.lit(""))), "")
        return materialize(paths.select(
            "doc_id", *(_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")), F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
            _hex(F.col("folded_root")).alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified")), "manifest")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
