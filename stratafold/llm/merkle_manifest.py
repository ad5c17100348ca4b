"""Merkle manifest: a tree of digests per source, a tree over their roots, and a proof per document.

Leaves are numbered in order within their source and every three consecutive ones
become their digest, level by level. Proofs come by pointer jumping: an inner node
starts with the segment of its own siblings and a pointer to its parent; a
self-join with the node pointed to appends that node's segment and takes over its
pointer, which doubles the distance. Only nodes whose level is a multiple of the
distance jump on; the others then join once with the completed path of the node
they point to. So at most about the root of the number of leaves share a pointer,
however large a source is, and a run of leaves fetches its parent's path in one
last jump.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.positions import numbered
from stratafold.llm.shared import Stages, literal_array

FAN = 3
# No table has more rows than the largest of these.
POWERS = [FAN**k for k in range(39)]

NULL_SOURCE = "-"
TOP = ""


def _encoded(value: Column) -> Column:
    """A value with its length before it, so that no two rows read alike."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _digest(parts: Column) -> Column:
    """Sha-256 of digests, taken as their hexadecimal text."""
    return F.unhex(F.sha2(F.lower(F.hex(parts)), 256))


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda whole, one: F.concat(whole, one))


def leaves(docs: DataFrame) -> DataFrame:
    """tree (source), doc_id, leaf, and the leaf of the tampered row where that differs."""

    def leaf(text: Column) -> Column:
        fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
        return F.unhex(F.sha2(F.concat(*[_encoded(f) for f in fields], _encoded(text)), 256))

    text = F.col("text")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(chosen & text.contains("\n"), leaf(F.replace(text, F.lit("\n"), F.lit(""))))
    tree = F.when(F.col("source").isNull(), NULL_SOURCE).otherwise(F.concat(F.lit("="), "source"))
    return docs.select(tree.alias("tree"), "doc_id", leaf(text).alias("digest"), tampered.alias("tampered"))


def _height(rows: Column) -> Column:
    """Levels above the leaves: the least power of the fan that holds them."""
    return F.size(F.filter(literal_array(POWERS, "long"), lambda p: p < rows))


def _div(name: str, by: int) -> Column:
    return F.expr(f"{name} div {by}L")


def _runs(nodes: DataFrame, *payload: str) -> DataFrame:
    """Every ``FAN`` consecutive nodes of a tree as one row, its members in order."""
    member = F.struct((F.col("idx") % FAN).alias("slot"), "digest", *payload)
    grouped = nodes.groupBy("tree", "height", _div("idx", FAN).alias("run"))
    return grouped.agg(F.sort_array(F.collect_list(member)).alias("members"))


def _parents(runs: DataFrame) -> DataFrame:
    """The node above each run; a lone leaf is its own tree's root."""
    whole = _digest(_joined(F.col("members.digest")))
    digest = F.when(F.col("height") > 0, whole).otherwise(F.col("members")[0]["digest"])
    return runs.select("tree", "height", F.col("run").alias("idx"), digest.alias("digest"))


def _grown(placed: DataFrame, stages: Stages, *payload: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level, the leaves' first, and each tree's root (tree, height, digest).

    ``placed``: tree, rank, group_rows, digest and the payload of the leaves.
    """
    nodes = placed.select("tree", _height(F.col("group_rows")).alias("height"), F.col("rank").alias("idx"), "digest", *payload)
    levels = [stages.write(_runs(nodes, *payload), "runs")]
    highest = levels[0].agg(F.max("height")).first()[0] or 0
    roots = [_parents(levels[0]).where("height <= 1")]
    for level in range(1, highest):
        nodes = _parents(levels[-1]).where(F.col("height") > level)
        levels.append(stages.write(_runs(nodes), "runs"))
        roots.append(_parents(levels[-1]).where(F.col("height") == level + 1))
    return levels, reduce(DataFrame.unionByName, roots).select("tree", "height", "digest")


def _siblings(slot: Column) -> Column:
    """The members of a run before and after a slot, each end to end."""
    digests = F.col("members.digest")
    left = F.slice(digests, F.lit(1), slot)
    right = F.slice(digests, slot + 2, F.lit(FAN))
    return F.struct(_joined(left).alias("l"), _joined(right).alias("r"))


def _first_steps(levels: list[DataFrame]) -> DataFrame | None:
    """Inner nodes below their tree's root with the segment of their own siblings."""
    found = []
    for level, runs in enumerate(levels[1:], 1):
        nodes = runs.select("tree", "height", "run", "members", F.posexplode("members.slot").alias("slot", "own"))
        idx = (F.col("run") * FAN + F.col("slot")).alias("idx")
        path = F.array(_siblings(F.col("slot"))).alias("path")
        found.append(nodes.select("tree", "height", F.lit(level).alias("level"), idx, path))
    return reduce(DataFrame.unionByName, found) if found else None


def _pointer(distance: int) -> list[Column]:
    """The node ``distance`` levels up, or the tree's root where that is nearer."""
    beyond = F.col("level") + distance >= F.col("height")
    up = F.least(F.col("level") + distance, F.col("height")).cast("int")
    idx = F.lit(0).cast("long") if distance >= len(POWERS) else F.when(beyond, F.lit(0).cast("long")).otherwise(_div("idx", POWERS[distance]))
    return [up.alias("up_level"), idx.alias("up_idx")]


def _climbed(levels: list[DataFrame], ends: DataFrame, stages: Stages) -> DataFrame:
    """The whole path of each inner node: tree, level, idx, path, subroot, root.

    ``ends`` has the trees' own roots in that form.
    """
    jumps = [_first_steps(levels)]
    if jumps[0] is None:
        return ends
    distance = 1
    while 2 * distance < len(levels):
        # nodes twice the distance apart append the segment of the node between
        known = jumps[-1]
        there = known.select("tree", F.col("level").alias("up_level"), F.col("idx").alias("up_idx"), F.col("path").alias("more"))
        here = known.where(F.col("level") % (2 * distance) == 0).select("*", *_pointer(distance))
        joined = here.join(there, ["tree", "up_level", "up_idx"], "left")
        path = F.concat("path", F.coalesce("more", F.array().cast(there.schema["more"].dataType)))
        jumps.append(stages.write(joined.select("tree", "height", "level", "idx", path.alias("path")), "jumps"))
        distance *= 2
    done = [ends]
    for steps in reversed(jumps):
        # the nodes between, and any whose jump ends at the root, reach a completed path
        ended = reduce(DataFrame.unionByName, done).select(
            "tree", F.col("level").alias("up_level"), F.col("idx").alias("up_idx"), F.col("path").alias("more"), "subroot", "root"
        )
        here = steps if steps is jumps[-1] else steps.where(F.col("level") % (2 * distance) != 0)
        joined = here.select("*", *_pointer(distance)).join(ended, ["tree", "up_level", "up_idx"])
        found = joined.select("tree", "level", "idx", F.concat("path", "more").alias("path"), "subroot", "root")
        done.append(stages.write(found, "paths"))
        distance //= 2
    return reduce(DataFrame.unionByName, done)


def _of_leaves(runs: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per leaf: its member struct, and the steps from it to the root."""
    bottom = F.least(F.col("height"), F.lit(1)).cast("int")
    keyed = runs.select("tree", "members", bottom.alias("level"), F.col("run").alias("idx"))
    joined = keyed.join(paths, ["tree", "level", "idx"])
    each = joined.select("level", "members", "path", "subroot", "root", F.posexplode("members").alias("slot", "m"))
    # a lone leaf is its tree's root and takes no step there
    steps = F.when(F.col("level") > 0, F.concat(F.array(_siblings(F.col("slot"))), "path")).otherwise(F.col("path"))
    return each.select("m", steps.alias("steps"), "subroot", "root")


def _tree_paths(placed: DataFrame, stages: Stages) -> DataFrame:
    """The tree over the sources' roots: source tree, its root, its path and the last root."""
    levels, top = _grown(placed, stages, "of")
    no_steps = F.array().cast("array<struct<l:binary,r:binary>>").alias("path")
    end = top.select("tree", F.col("height").cast("int").alias("level"), F.lit(0).cast("long").alias("idx"), no_steps, F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    found = _of_leaves(levels[0], _climbed(levels, end, stages))
    return found.select(F.col("m.of").alias("tree"), F.col("m.digest").alias("subroot"), F.col("steps").alias("path"), "root")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (the steps), proof_sha256, folded_root, verified.

    Every row is a leaf, rows without an id or a source included; the latter are a
    source of their own, before the others. Leaves of one source are in the order of
    their ids (null first) and, for one id, of their digests, so repeated rows
    have a defined place. A step has the siblings to the left and to the right, end
    to end; a lone member of a run has none. Rows without an id are not tampered with.
    """
    stages = Stages(docs.sparkSession)
    own = stages.write(leaves(docs), "leaves")
    placed = numbered(own, "tree", ["doc_id", "digest"], stages)
    levels, roots = _grown(placed, stages, "doc_id", "tampered")
    roots = stages.write(roots, "roots")
    subroots = roots.select(F.lit(TOP).alias("top"), F.col("tree").alias("of"), "digest")
    placed = numbered(stages.write(subroots, "subroots"), "top", ["of"], stages).withColumnRenamed("top", "tree")
    ends = stages.write(_tree_paths(placed, stages).join(roots.select("tree", "height"), "tree"), "ends")
    ends = ends.select("tree", F.col("height").cast("int").alias("level"), F.lit(0).cast("long").alias("idx"), "path", "subroot", "root")
    found = _of_leaves(levels[0], _climbed(levels, ends, stages))
    start = F.coalesce("m.tampered", "m.digest")
    folded = F.aggregate("steps", start, lambda node, s: _digest(F.concat(s["l"], node, s["r"])))
    proof = F.aggregate("steps", F.lit(b""), lambda whole, s: F.concat(whole, s["l"], s["r"]))
    return found.select(
        F.col("m.doc_id").cast("long").alias("doc_id"),
        _text(F.col("m.digest")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        _text(F.col("root")).alias("root"),
        F.col("steps").alias("proof"),
        F.sha2(_text(proof), 256).alias("proof_sha256"),
        _text(folded).alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


# The SQL unrolls so many levels; three to that power is more leaves than a table of it holds.
SQL_LEVELS = 20


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


def _sql_tree(name: str, leaves: str, levels: int) -> str:
    """CTEs: the nodes of each level of ``leaves`` (tree, i, d, n) and the path of each leaf."""
    parts = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS (SELECT tree, i // 3 AS i, (n + 2) // 3 AS n, "
            f"CASE WHEN n = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}{k} GROUP BY tree, i // 3, n)"
        )
        frame = "PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN"
        parts.append(
            f"{name}s{k} AS (SELECT tree, i, n, coalesce(string_agg(d, '') OVER ({frame} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(d, '') OVER ({frame} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
        )
        before = f"{name}p{k}" if k else f"(SELECT tree, i AS leaf, i, [] :: STRUCT(l VARCHAR, r VARCHAR)[] AS steps FROM {name}0)"
        parts.append(
            f"{name}p{k + 1} AS (SELECT p.tree, p.leaf, p.i // 3 AS i, CASE WHEN s.n = 1 THEN p.steps "
            f"ELSE list_append(p.steps, {{'l': s.l, 'r': s.r}}) END AS steps FROM {before} p JOIN {name}s{k} s ON s.tree = p.tree AND s.i = p.i)"
        )
    return ",\n".join(parts)


def sql(levels: int = SQL_LEVELS) -> str:
    """The manifest without its ``proof`` column, over the view ``documents``."""
    fields = " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = (
        "xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), "
        "lambda p: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(p AS INTEGER), 1)) AS BIGINT))), "
        "lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), "
        "lambda a, j: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))"
    )
    return f"""
WITH rows_of AS (
    SELECT doc_id, coalesce('=' || source, '-') AS tree, sha256({fields} || {_sql_field("text")}) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed,
        source, lang, n_chars
    FROM documents
), placed AS (
    SELECT doc_id, tree, leaf, sha256({fields} || {_sql_field("changed")}) AS tampered,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
    FROM rows_of
), {_sql_tree("a", "SELECT tree, i, n, leaf AS d FROM placed", levels)},
roots AS (
    SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, d, tree AS of FROM a{levels}
), {_sql_tree("b", "SELECT tree, i, n, d FROM roots", levels)},
paths AS (
    SELECT p.doc_id, p.leaf, p.tampered, r.d AS subroot, (SELECT d FROM b{levels}) AS root, list_concat(x.steps, y.steps) AS steps
    FROM placed p JOIN ap{levels} x ON x.tree = p.tree AND x.leaf = p.i
    JOIN roots r ON r.of = p.tree JOIN bp{levels} y ON y.leaf = r.i
), folded AS (
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda s: s.l || s.r), ''), '')) AS proof_sha256,
        list_reduce(list_concat([{{'l': tampered, 'r': ''}}], steps), lambda n, s: {{'l': sha256(s.l || n.l || s.r), 'r': ''}}).l AS folded_root
    FROM paths
)
SELECT *, folded_root = root AS verified FROM folded
"""
