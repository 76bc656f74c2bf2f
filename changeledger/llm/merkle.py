"""Merkle manifest of documents: a binary hash tree per language, one over their roots, and proofs.

Every row is a leaf. Levels are built by joining neighbours in order, and stored as rows that name
their parent and the siblings on the way to it. A recursive query then climbs from every leaf to the
root: each step folds the hash with the siblings of the node it stands on, appends them to the proof
and goes to the parent row.

Columns: `doc_id`, `source`, `lang`, `n_chars`, `text`; others are ignored, whatever their names.
Nulls in any of the five are hashed as `-`, so null and empty differ; a null language has a tree of
its own, before all others. Rows of one language are ordered by doc_id, null first; those that share
it by their hash. Equal rows are leaves of their own. An empty table has an empty manifest.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.operators.broadcasting import broadcast_if_small

from .batches import stored
from .order import numbered

#: Levels between a stored row and its parent row: a block of 2**SPAN neighbours is joined in one task.
SPAN = 10

#: Documents whose id has a crc32 that this divides are checked with a changed n_chars.
TAMPERED_MODULUS = 7

#: Number of the tree over the roots of the languages; theirs are numbered from 0.
TOP = -1


def _field(column: Column) -> Column:
    """Byte count, colon and value, so that no two rows have the same concatenation; `-` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """SHA-256 of a row, in lowercase hex."""
    return F.sha2(F.concat(*[_field(column) for column in (doc_id, source, lang, n_chars, text)]), 256)


def leaves(documents: DataFrame) -> DataFrame:
    """(`lang`, `doc_id`, `leaf`, `tampered`): the hash of each row, and the one it is checked with."""
    row = {name: F.col(f"`{name}`") for name in ("doc_id", "source", "lang", "n_chars", "text")}
    is_tampered = F.crc32(row["doc_id"].cast("bigint").cast("string")) % TAMPERED_MODULUS == 0
    changed = F.when(is_tampered, F.try_add(row["n_chars"].cast("bigint"), F.lit(1))).otherwise(row["n_chars"].cast("bigint"))
    return documents.select(
        row["lang"].cast("string").alias("lang"),
        row["doc_id"].cast("bigint").alias("doc_id"),
        leaf_hash(**row).alias("leaf"),
        leaf_hash(**{**row, "n_chars": F.coalesce(changed, row["n_chars"])}).alias("tampered"),
    )


def _height(size: Column) -> Column:
    """Levels above the leaves: the binary logarithm, rounded up."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0)


_NO_ROW = "struct<doc_id:bigint,tampered:binary>"

#: All levels of a block, from its members up: neighbours joined until `span` levels stand on it.
_LEVELS = """aggregate(
    slice(sequence(1, {span}), 1, span), array(transform(members, m -> m.hash)),
    (built, k) -> array_append(built, transform(
        sequence(0, (size(element_at(built, -1)) - 1) div 2),
        i -> sha2(concat(element_at(built, -1)[2 * i], coalesce(get(element_at(built, -1), 2 * i + 1), '')), 256))))"""

#: The other node of each run on the way up, left or right of the path; neither for a run of one.
_SIBLINGS = """transform(
    slice(sequence(0, {span} - 1), 1, span),
    k -> named_struct(
        'left', CASE WHEN shiftright(place, k) & 1 = 1 THEN unhex(get(levels[k], shiftright(place, k) - 1)) END,
        'right', CASE WHEN shiftright(place, k) & 1 = 0 THEN unhex(get(levels[k], shiftright(place, k) + 1)) END))"""


def _blocks(nodes: DataFrame, level: int) -> DataFrame:
    """Blocks of at most 2**SPAN neighbours with all the levels over them."""
    member = F.struct("index", "hash", "row")
    gathered = nodes.groupBy("tree", "height", F.shiftright("index", SPAN).alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    spanned = gathered.withColumn("span", F.least(F.lit(SPAN), F.col("height") - level))
    return stored(spanned.withColumn("levels", F.expr(_LEVELS.format(span=SPAN))), "merkle-blocks")


def _parent_linked(blocks: DataFrame, level: int) -> DataFrame:
    """A row per node: its hash, the siblings on the way to its parent row, and which row that is.

    The last row of a language's tree links to the leaf of the top tree that its root is; the root of
    the top tree links to nothing.
    """
    rows = blocks.select("*", F.posexplode("members").alias("place", "member")).withColumn("siblings", F.expr(_SIBLINGS.format(span=SPAN)))
    ends = F.col("span") + level == F.col("height")
    is_top = F.col("tree") == TOP
    is_root = is_top & (F.col("height") == level)
    return rows.select(
        F.col("tree"), F.lit(level).alias("level"), F.col("member.index").alias("index"), F.unhex("member.hash").alias("hash"), "siblings",
        F.when(~is_root, F.when(ends, F.lit(TOP)).otherwise(F.col("tree")).cast("bigint")).alias("parent_tree"),
        F.when(ends & ~is_top, F.lit(0)).otherwise(F.lit(level) + F.col("span")).alias("parent_level"),
        F.when(ends & ~is_top, F.col("tree")).otherwise(F.col("block")).alias("parent_index"),
        F.col("member.row").alias("row"),
    )


def _grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Parent-linked rows by level, and the root (`tree`, `hash`) of every tree over (`tree`, `height`, `index`, `hash`, `row`)."""
    links, roots, level = [], None, 0
    height = nodes.agg(F.max("height").alias("height")).first()["height"]
    while True:
        blocks = _blocks(nodes, level)
        links.append(_parent_linked(blocks, level))
        joined = blocks.select("tree", "height", F.col("block").alias("index"), F.col("levels")[F.col("span")][0].alias("hash"), F.lit(None).cast(_NO_ROW).alias("row"))
        ended = joined.where(F.col("height") <= level + SPAN).select("tree", "hash")
        roots = ended if roots is None else roots.unionByName(ended)
        if height is None or height <= level + SPAN:
            return links, roots
        level += SPAN
        nodes = joined.where(F.col("height") > level)


def _root_row(root: DataFrame, height: Column) -> DataFrame:
    """The root of the top tree, on which every climb ends; a tree of one node has it already."""
    nothing, none = F.lit(None).cast("bigint"), F.lit(None).cast(_NO_ROW)
    siblings = F.array().cast("array<struct<left:binary,right:binary>>")
    end = root.select("tree", height.alias("level"), F.lit(0).cast("bigint").alias("index"), F.unhex("hash").alias("hash"), siblings.alias("siblings"),
        nothing.alias("parent_tree"), nothing.cast("int").alias("parent_level"), nothing.alias("parent_index"), none.alias("row"))
    return end.where("level > 0")


def parent_linked_nodes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaf rows, all rows above them) of the manifest, both stored."""
    placed = stored(numbered(leaves(documents), "lang", ["doc_id", "leaf"], "merkle-leaves"), "merkle-leaves")
    # Trees are numbered in the order of the languages; `lang` alone orders them, so the group is one constant.
    langs = placed.where("position = 0").select(F.lit(0).alias("all"), "lang")
    trees = numbered(langs, "all", ["lang"], "merkle-trees").select(F.col("lang").alias("_lang"), F.col("position").alias("tree"), F.col("size").alias("n_trees"))
    trees = stored(trees, "merkle-trees")
    row = F.struct("doc_id", F.unhex("tampered").alias("tampered")).alias("row")
    in_trees = placed.join(broadcast_if_small(trees), F.col("lang").eqNullSafe(F.col("_lang")))
    bottom, roots = _grown(in_trees.select("tree", _height(F.col("size")).alias("height"), F.col("position").alias("index"), F.col("leaf").alias("hash"), row))
    n_trees = F.coalesce(trees.agg(F.max("n_trees")).scalar(), F.lit(0))
    empty_row = F.lit(None).cast(_NO_ROW).alias("row")
    top_nodes = roots.select(F.lit(TOP).cast("bigint").alias("tree"), _height(n_trees).alias("height"), F.col("tree").alias("index"), "hash", empty_row)
    top, top_root = _grown(top_nodes)
    upper = bottom[1:] + top + [_root_row(top_root, _height(n_trees))]
    above = upper[0]
    for frame in upper[1:]:
        above = above.unionByName(frame)
    return stored(bottom[0], "merkle-leaf-nodes"), stored(above.drop("row"), "merkle-nodes")


# One step folds the hash with the siblings of the node it stands on and goes to the parent row.
_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT row.doc_id AS doc_id, hash AS leaf, CAST(NULL AS BINARY) AS subroot, hash,
    row.tampered AS folded, CAST(X'' AS BINARY) AS proof, siblings, parent_tree, parent_level, parent_index
  FROM {leaf_nodes}
  UNION ALL
  SELECT c.doc_id, c.leaf, CASE WHEN n.level = 0 THEN n.hash ELSE c.subroot END, n.hash,
    aggregate(c.siblings, c.folded, (below, s) -> unhex(sha2(concat(
      coalesce(lower(hex(s.left)), ''), lower(hex(below)), coalesce(lower(hex(s.right)), '')), 256))),
    aggregate(c.siblings, c.proof, (before, s) -> concat(before, coalesce(s.left, X''), coalesce(s.right, X''))),
    n.siblings, n.parent_tree, n.parent_level, n.parent_index
  FROM climb c JOIN {nodes} n ON n.tree = c.parent_tree AND n.level = c.parent_level AND n.index = c.parent_index
)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(hash)) AS root,
  sha2(lower(hex(proof)), 256) AS proof_sha256, lower(hex(folded)) AS folded_root, folded = hash AS verified
FROM climb WHERE parent_tree IS NULL"""


@contextmanager
def _unlimited_rows(spark: SparkSession):
    """Recursion over tables of any size; the session's limit is put back."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def manifest(documents: DataFrame) -> DataFrame:
    """(`doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified`) for every row.

    Steps of the climb are as many as the height divided by SPAN, and one for the tree over the
    languages. The rows above the leaves are fewer by 2**SPAN; they are broadcast within a measured
    size and else joined by shuffle, where adaptive execution splits the nodes that all paths share.
    """
    spark = documents.sparkSession
    leaf_nodes, nodes = parent_linked_nodes(documents)
    with _unlimited_rows(spark):
        climbed = spark.sql(_CLIMB, leaf_nodes=leaf_nodes, nodes=broadcast_if_small(nodes))
        return stored(climbed, "merkle-proofs")
