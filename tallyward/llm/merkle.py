"""Merkle manifest of a dataset: one digest for all of it, and for each row a proof that it belongs.

Rows are leaves.  Per source, leaves in order of their id are hashed in runs of ``FAN`` until one node remains, the
subroot; subroots in order of their source are hashed likewise to the root.

Each tree is cut into aligned blocks of ``FAN ** DEPTH`` consecutive nodes.  A task walks a block recursively in
postorder: a call returns its subtree's digest, and while calls unwind, each appends to the
leaves below it the siblings they meet on that level.  Block roots are the leaves of another distributed walk, until
each tree has one root.  Going down again, a block gets the path from its own root to the top once,
and its walk ends in the proofs of its leaves.

A node's place in its tree comes from sorting by range: rows are written sorted, each part counts its rows
of a tree, and the counts of earlier parts are summed per tree.  So no source, however large, is sorted or held by one task;
a task holds one block.

Defined results: an empty table has no rows.  Null fields are hashed as ``-``.  Rows without an id come first in their source,
rows that share an id in order of their leaves; rows alike throughout are as many equal leaves, side by side.  A null source is a source of its own,
before that of the empty name.  Extra columns play no part; columns that are missing are null.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import BROADCAST_BYTES, dropped, written
from .exact_dedup import LOWER, UPPER

#: Nodes of a run; levels of a block: 4,096 leaves.
FAN, DEPTH = 16, 3
#: A path: for each level upwards, the place among the run and the run's other digests.
PATH = "array<struct<at:int,others:string>>"
FIELDS = (("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(cells: list[Column]) -> Column:
    """Digest of a row's fields, 32 bytes; each field told with its length in bytes, ``-`` for null."""
    told = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[told(c.cast("string")) for c in cells]).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, tampered`` of each row; tampered: the leaf of a row altered on purpose, null for the others.

    tree orders sources: null first, then by their bytes.
    """
    have = {c.lower() for c in docs.columns}
    rows = docs.select(*[(F.col(n) if n in have else F.lit(None)).cast(kind).alias(n) for n, kind in FIELDS])
    cells = [F.col(n) for n, _ in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"), "doc_id", leaf(cells).alias("leaf"),
        F.when(chosen, leaf([*cells[:-1], F.translate("text", UPPER, LOWER)])).alias("tampered"))


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``place``, from 0 in each ``tree`` by ``order``, and ``size``, the tree's nodes; written.

    Sorted by range over all trees, so that one of any size is spread over tasks.
    """
    marks = {"row": F.monotonically_increasing_id(), "part": F.spark_partition_id()}
    rows = written(nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumns(marks), "sorted")
    parts = written(rows.groupBy("part", "tree").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")), "parts")
    tree = Window.partitionBy("tree")  # a row for each part that holds some of the tree
    so_far = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = parts.select("part", "tree", (so_far - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size"))
    if parts.count() * ROW_BYTES <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    out = written(rows.join(starts, ["part", "tree"]).withColumn("place", F.col("row") + F.col("shift")).drop("part", "row", "shift"), "placed")
    dropped(rows)
    dropped(parts)
    return out


#: Upper estimate of a row with the name of a tree.
ROW_BYTES = 512


def height(size: int, fan: int, depth: int) -> int:
    """Levels of a block in a tree of so many nodes."""
    levels = 0
    while fan**levels < size and levels < depth:
        levels += 1
    return levels


def walk(nodes: list[str], levels: int, fan: int) -> tuple[str, list[list[tuple[int, str]]]]:
    """Digest of a block, and for each of its nodes, level by level, the place in the run and the run's other digests."""
    met: list[list[tuple[int, str]]] = [[] for _ in nodes]

    def visit(first: int, level: int) -> str:
        if level == 0:
            return nodes[first]
        step = fan ** (level - 1)
        starts = range(first, min(first + fan**level, len(nodes)), step)
        run = [visit(at, level - 1) for at in starts]
        for k, at in enumerate(starts):
            seen = k, "".join(run[:k] + run[k + 1 :])
            for below in range(at, min(at + step, len(nodes))):
                met[below].append(seen)
        return sha("".join(run))

    return visit(0, levels), met


def folded(node: str, path: list[tuple[int, str]]) -> str:
    """The digest at the end of a path that begins at ``node``."""
    for at, others in path:
        node = sha(others[: 64 * at] + node + others[64 * at :])
    return node


def _sorted(block: pa.Table) -> tuple[pa.Table, list[str], int]:
    """A block in order of its places, its digests, and the size of its tree."""
    block = block.sort_by("place")
    return block, [x.hex() for x in block["leaf"].to_pylist()], block["size"][0].as_py()


def _in_blocks(nodes: DataFrame, span: int):
    return nodes.withColumn("block", F.expr(f"place div {span}")).groupBy("tree", "block")


def roots(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """The roots of blocks of ``nodes (tree, place, size, leaf)``, as nodes of the next walk."""

    def run(block: pa.Table) -> pa.Table:
        tree, block_no = block["tree"][0].as_py(), block["block"][0].as_py()
        _, own, size = _sorted(block)
        top, _ = walk(own, height(size, fan, depth), fan)
        return pa.table({"tree": [tree], "place": pa.array([block_no], pa.int64()), "size": pa.array([-(-size // fan**depth)], pa.int64()), "leaf": [bytes.fromhex(top)]})

    slim = nodes.select("tree", "place", "size", "leaf")
    return written(_in_blocks(slim, fan**depth).applyInArrow(run, "tree string, place long, size long, leaf binary"), "block_roots")


def _pairs(cell: list[dict]) -> list[tuple[int, str]]:
    return [(x["at"], x["others"]) for x in cell]


def paths(nodes: DataFrame, above: DataFrame, fan: int, depth: int) -> DataFrame:
    """``tree, place, path``: of each node to the top; ``above (tree, block, path)`` has the paths of the blocks' roots."""

    def run(block: pa.Table, top: pa.Table) -> pa.Table:
        block, own, size = _sorted(block)
        rest = _pairs(top["path"][0].as_py())
        _, met = walk(own, height(size, fan, depth), fan)
        cells = [[{"at": a, "others": o} for a, o in [*m, *rest]] for m in met]
        kind = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))
        return pa.table({"tree": block["tree"], "place": block["place"], "path": pa.array(cells, kind)})

    slim = nodes.select("tree", "place", "size", "leaf")
    return written(_in_blocks(slim, fan**depth).cogroup(above.groupBy("tree", "block")).applyInArrow(run, f"tree string, place long, path {PATH}"), "paths")


def climbed(nodes: DataFrame, fan: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each walk, lowest first, and ``tree, leaf``: the trees' roots."""
    walks, tops = [nodes], None
    while True:
        found = roots(walks[-1], fan, depth)
        done = found.where("size = 1").select("tree", "leaf")
        tops = done if tops is None else tops.unionByName(done)
        higher = found.where("size > 1")
        if higher.isEmpty():
            return walks, tops
        walks.append(higher)


def block_paths(walks: list[DataFrame], ends: DataFrame, fan: int, depth: int) -> DataFrame:
    """``tree, block, path`` for the blocks of the lowest walk; ``ends (tree, path)`` has the path of each tree's root."""
    span, above = fan**depth, None
    for at in range(len(walks) - 1, -1, -1):
        alone = walks[at].where(F.col("size") <= span).select("tree").distinct().join(ends, "tree").select("tree", F.lit(0).cast("long").alias("block"), "path")
        above = written(alone if above is None else alone.unionByName(above), "block_paths")
        if at:
            above = paths(walks[at], above, fan, depth).select("tree", F.col("place").alias("block"), "path")
    return above


def manifest(docs: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row of ``docs``.

    folded_root starts from the tampered leaf where there is one, and goes up the original path.
    """
    span = fan**depth
    told = written(leaves(docs), "leaves")  # sorting by range reads its input twice; the texts are read once
    nodes = placed(told, "doc_id", "leaf", "tampered")
    dropped(told)
    walks, subroots = climbed(nodes, fan, depth)
    top_nodes = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "leaf"), "name")
    top_walks, top = climbed(top_nodes, fan, depth)
    last = top.first()
    root = last["leaf"].hex() if last else ""
    end = docs.sparkSession.createDataFrame([("", [])], f"tree string, path {PATH}")
    top_paths = paths(top_nodes, block_paths(top_walks, end, fan, depth), fan, depth)
    ends = written(top_nodes.join(top_paths, ["tree", "place"]).select(F.col("name").alias("tree"), "leaf", "path"), "subroots")
    above = written(block_paths(walks, ends.select("tree", "path"), fan, depth).join(ends.select("tree", F.col("leaf").alias("subroot")), "tree"), "block_ends")

    def prove(block: pa.Table, up: pa.Table) -> pa.Table:
        block, own, size = _sorted(block)
        rest, subroot = _pairs(up["path"][0].as_py()), up["subroot"][0].as_py().hex()
        tail = "".join(others for _, others in rest)
        _, met = walk(own, height(size, fan, depth), fan)
        ends = [folded(node if changed is None else changed.hex(), [*m, *rest]) for node, changed, m in zip(own, block["tampered"].to_pylist(), met, strict=True)]
        n = len(own)
        return pa.table({
            "doc_id": block["doc_id"], "leaf": own, "subroot": [subroot] * n, "root": [root] * n,
            "proof_sha256": [sha("".join([*(others for _, others in m), tail])) for m in met], "folded_root": ends, "verified": [x == root for x in ends]})

    return _in_blocks(nodes, span).cogroup(above.groupBy("tree", "block")).applyInArrow(
        prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _levels(stem: str, n: int) -> str:
    """SQL of the nodes of levels 1 to n and of each level's runs, from ``{stem}0 (tree, p, h)``."""
    return ",".join(f"""
{stem}r{k} as (
  select tree, p // {FAN} as run, list(h order by p) as hs, any_value(m) as m
  from (select *, count(*) over (partition by tree) as m from {stem}{k}) group by all),
{stem}{k + 1} as (select tree, run as p, if(m = 1, hs[1], sha256(array_to_string(hs, ''))) as h from {stem}r{k})""" for k in range(n))


def _up(stem: str, n: int, before: str) -> str:
    """SQL that takes the rows of ``before (tree, place, folded, others)`` through the runs of n levels."""
    out = []
    for k in range(n):
        source = before if k == 0 else f"{stem}f{k - 1}"
        at = f"CAST(place // {FAN**k} % {FAN} AS INTEGER)"
        out.append(f"""
{stem}f{k} as (
  select l.* replace (if(m = 1, folded, sha256(array_to_string(hs[:{at}] || [folded] || hs[{at} + 2:], ''))) as folded,
                      if(m = 1, others, others || array_to_string(hs[:{at}] || hs[{at} + 2:], '')) as others)
  from {source} l join {stem}r{k} r on l.tree = r.tree and r.run = l.place // {FAN ** (k + 1)})""")
    return ",".join(out)


def _oracle(tree_levels: int, top_levels: int) -> str:
    told = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"
    row = lambda text: "sha256(" + " || ".join(told(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    return f"""
with recursive table_of as (  -- the 256 remainders of the checksum
  select b, list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) as v from (select unnest(range(256)) as b)),
crcs as (select list(v order by b) as t from table_of),
leaf as (
  select doc_id, coalesce('=' || source, '') as tree, {row('"text"')} as leaf, {row(f"""translate("text", '{UPPER}', '{LOWER}')""")} as changed,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                         lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 5 = 0 as chosen
  from documents, crcs),
base as materialized (
  select doc_id, tree, leaf, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place, if(coalesce(chosen, false), changed, leaf) as folded, '' as others from leaf),
t0 as (select tree, place as p, leaf as h from base),{_levels("t", tree_levels)},
tops as (select tree as name, h as subroot, row_number() over (order by tree) - 1 as seat from t{tree_levels}),
u0 as (select '' as tree, seat as p, subroot as h from tops),{_levels("u", top_levels)},{_up("t", tree_levels, "base")},
joined as (
  select doc_id, leaf, subroot, '' as tree, seat as place, folded, others from t{f"f{tree_levels - 1}"} f join tops on f.tree = tops.name),{_up("u", top_levels, "joined")}
select doc_id, leaf, subroot, root, sha256(others) as proof_sha256, folded as folded_root, folded = root as verified
from uf{top_levels - 1}, (select h as root from u{top_levels})
"""


#: DuckDB's SQL for the registered query, for up to 16^5 rows a source and 16^3 sources.
ORACLE = _oracle(5, 3)
