"""Merkle manifest of a table with octopus multiproofs.

A leaf is the hash of a row; the leaves of a source, in order of their ids, are the lowest level of its tree, in which every
``FAN`` consecutive nodes (the last run may have fewer) become their parent until one node, the subroot, remains.  The
subroots, in order of their sources, are the leaves of one more tree, whose top is the root.  H is the sha256 of its
inputs one after another, in lowercase hex; digests go into it as hex text.

1. Leaves are hashed where the rows are, without a shuffle of texts, stored, and dealt into ranges of (source, id).
   A task cuts its range into slices of at most ``SLICE`` leaves; a slice is one row of packed digests, so nothing
   depends on how rows are batched later.  Two numbers for each range (how many sources, how many rows of its last
   source came before) go through the driver; all other counts stay in Spark.
2. A slice knows which runs it holds as a whole and derives those nodes itself.  What is left at its edges is its frontier; the few
   nodes above frontiers of different slices are grouped level by level in Spark.  A source that lies in one slice gives its subroot.
   No group ever holds more than ``FAN`` nodes, so a hot source is as good as any other.
3. A slice's multiproof is the minimal union of the coordinates that it can't derive, over both trees: level by level, the children of
   the runs that its known nodes touch, less the known nodes; the runs are known one level up.  The coordinates are joined
   with the stored nodes and fetched once for each slice, shared interiors are derived once, and the proof of each
   leaf is expanded from them inside the slice.

Null ids come before all others, rows with equal ids are ordered by their leaf digest; equal rows are interchangeable, each has a
place of its own.  Null sources form the first tree; a null or empty text is a value like any other (``-`` and ``0:``).
Texts are hashed whole, whatever their length.  Other columns are ignored.  An empty table gives no rows.  A row with a null id isn't tampered with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import materialise, shuffle_parts

FAN, SLICE = 16, 1 << 14
#: ids whose crc32 this number divides are tampered with
TAMPERED = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: the tree over the sources' subroots
TOP = -1
_SLICE = "part int, slice int, g int, before long, docs array<long>, leaves binary, folded binary, runs array<struct<source:string,n:long>>"
_NODE = "tree long, level int, idx long, n long, digest binary"


def hashed(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    """The digest of a row, from its columns in the order of ``FIELDS``."""
    return F.sha2(F.encode(F.concat(*(_field(columns[c]) for c in FIELDS)), "UTF-8"), 256)


def tamper(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())


def leaves(docs: DataFrame, tampered: bool = True) -> DataFrame:
    """(source, doc_id, leaf, folded): digests as 32 bytes; ``folded`` is the leaf of the row as it is found later."""
    columns = {c: F.col(c) for c in FIELDS}
    own = leaf(columns)
    hit = (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % TAMPERED == 0) if tampered else F.lit(False)
    later = F.when(hit, leaf(columns | {"text": tamper(F.col("text"))})).otherwise(own)
    return docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(own).alias("leaf"), F.unhex(later).alias("folded"))


def slices(rows: DataFrame) -> DataFrame:
    """Leaves in global order, cut into slices: ``g`` counts the sources of the range before the slice's first, ``before`` the
    leaves of that source that earlier slices of the range hold."""
    schema = pa.schema([("part", pa.int32()), ("slice", pa.int32()), ("g", pa.int32()), ("before", pa.int64()), ("docs", pa.list_(pa.int64())), ("leaves", pa.binary()),
                        ("folded", pa.binary()), ("runs", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, g, before = TaskContext.get().partitionId(), 0, 0, 0
        docs, own, later, runs = [], [], [], []

        def closed():
            return pa.RecordBatch.from_pylist([{"part": part, "slice": number, "g": g, "before": before, "docs": docs, "leaves": b"".join(own),
                                                "folded": b"".join(later), "runs": [{"source": s, "n": n} for s, n in runs]}], schema=schema)

        for batch in batches:
            for source, doc, digest, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if len(docs) == SLICE:
                    yield closed()
                    last, n = runs[-1]
                    before = n + (before if len(runs) == 1 else 0) if source == last else 0
                    g, number = g + len(runs) - (source == last), number + 1
                    docs, own, later, runs = [], [], [], []
                if not runs or runs[-1][0] != source:
                    runs.append((source, 0))
                runs[-1] = (source, runs[-1][1] + 1)
                docs.append(doc)
                own.append(digest)
                later.append(found)
        if docs:
            yield closed()

    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("tie")]
    return (rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(shuffle_parts(rows.sparkSession), *order)
            .sortWithinPartitions(*order).select("source", "doc_id", "leaf", "folded").mapInArrow(run, _SLICE))


class Run(NamedTuple):
    """Consecutive leaves of one tree that a slice holds: places ``low`` to ``high`` (exclusive) of ``n``."""
    tree: int
    low: int
    high: int
    n: int


def outline(cut: DataFrame) -> DataFrame:
    """(part, slice, places array<struct<tree, low, high, n>>): the places of every slice's leaves, in order."""
    spark = cut.sparkSession
    light = cut.select("part", "slice", "g", "before", "runs")
    # one row for each range comes to the driver: its number of sources, its first and last source and their rows
    each = light.select("part", F.explode("runs").alias("r")).groupBy("part", "r.source").agg(F.sum("r.n").alias("n"))
    ranges = each.groupBy("part").agg(F.count("*").alias("sources"), F.min(F.struct("source", "n")).alias("first"), F.max(F.struct("source", "n")).alias("last"))
    offsets, g, held, last = [], 0, 0, None
    for r in ranges.orderBy("part").collect():
        goes_on = last is not None and last[0] == r["first"]["source"]
        g -= goes_on
        held = held if goes_on else 0
        offsets.append((r["part"], g, held))
        held = r["last"]["n"] + (held if r["sources"] == 1 else 0)
        g, last = g + r["sources"], (r["last"]["source"],)
    moved = F.broadcast(spark.createDataFrame(offsets, "part int, g0 long, held long"))  # a row for each range
    placed = light.join(moved, "part").select("part", "slice", (F.col("g") + F.col("g0")).alias("g"), F.posexplode("runs").alias("k", "r"),
                                              (F.col("before") + F.when(F.col("g") == 0, F.col("held")).otherwise(0)).alias("before"))
    placed = placed.select("part", "slice", (F.col("g") + F.col("k")).alias("tree"), F.when(F.col("k") == 0, F.col("before")).otherwise(0).alias("low"), F.col("r.n").alias("size"))
    sizes = placed.groupBy("tree").agg(F.sum("size").alias("n"))
    runs = placed.join(sizes, "tree").groupBy("part", "slice").agg(F.sort_array(F.collect_list(F.struct("tree", "low", (F.col("low") + F.col("size")).alias("high"), "n"))).alias("places"))
    return materialise(runs, "outline")


def widths(n: int) -> list[int]:
    """Nodes at each level of a tree of ``n`` leaves, up to one."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def parents(nodes: dict[int, bytes], width: int) -> dict[int, bytes]:
    """Parents of those runs of a level that ``nodes`` holds as a whole."""
    out, children = {}, {}
    for at in nodes:
        children.setdefault(at // FAN, []).append(at)
    for parent, own in children.items():
        if len(own) == min(width, (parent + 1) * FAN) - parent * FAN:
            out[parent] = hashed(*(nodes[c] for c in sorted(own)))
    return out


def frontier(run: Run, digests: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(level, idx, digest) of the nodes derived from a run of leaves whose parent can't be: its subroot, if it has all."""
    level = dict(enumerate(digests, run.low))
    for depth, width in enumerate(widths(run.n)):
        above = parents(level, width) if width > 1 else {}
        yield from ((depth, at, digest) for at, digest in level.items() if at // FAN not in above)
        level = above


def missing(low: int, high: int, n: int) -> Iterator[tuple[int, int]]:
    """The minimal union of (level, idx) that proofs of leaves ``low`` to ``high`` (exclusive) need and those leaves don't give."""
    for depth, width in enumerate(widths(n)[:-1]):
        first, last = low // FAN, (high - 1) // FAN
        yield from ((depth, at) for at in (*range(first * FAN, low), *range(high, min(width, (last + 1) * FAN))))
        low, high = first, last + 1


def _hex(packed: bytes) -> list[bytes]:
    text = packed.hex().encode()
    return [text[i:i + 64] for i in range(0, len(text), 64)]


def local_nodes(joined: DataFrame) -> DataFrame:
    """Frontier nodes of every slice."""
    schema = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                digests, at, out = _hex(packed), 0, []
                for r in (Run(**x) for x in runs):
                    mine, at = digests[at:at + r.high - r.low], at + r.high - r.low
                    out += [(r.tree, level, idx, r.n, bytes.fromhex(d.decode())) for level, idx, d in frontier(r, mine)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(schema.types)], schema=schema)

    return joined.select("leaves", "places").mapInArrow(run, _NODE)


def grown(nodes: DataFrame, name: str) -> DataFrame:
    """``nodes`` (tree, level, idx, n, digest) with the nodes above them: those of a level whose parent isn't there are grouped by
    their run, one small job a level, until each tree has its top."""
    width = lambda level: F.expr(f"cast(ceil(n / {FAN ** level}D) as bigint)")  # noqa: E731 - nodes of a tree at a level
    done, depth = nodes, 0
    highest = nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    while FAN ** depth < highest:
        children = done.where((F.col("level") == depth) & (width(depth) > 1))
        run = F.sort_array(F.collect_list(F.struct("idx", F.lower(F.hex("digest")).alias("d"))))  # FAN nodes at most
        text = F.encode(F.array_join(F.transform(run, lambda x: x["d"]), ""), "UTF-8")
        above = (children.groupBy("tree", "n", F.expr(f"idx div {FAN}").alias("idx")).agg(F.unhex(F.sha2(text, 256)).alias("digest"))
                 .select("tree", F.lit(depth + 1).alias("level"), "idx", "n", "digest"))
        done = done.unionByName(materialise(above, f"{name}-{depth + 1}"))
        depth += 1
    return done


class Manifest(NamedTuple):
    """Slices, the places of their leaves, and the stored nodes of all trees (subroots are the leaves of tree ``TOP``)."""
    cut: DataFrame
    outline: DataFrame
    nodes: DataFrame
    sources: int
    root: bytes


def build(docs: DataFrame, tampered: bool = True) -> Manifest | None:
    """Hash, order and store a table's leaves and the nodes above them; None for an empty table."""
    stored = materialise(leaves(docs, tampered), "leaves")
    cut = materialise(slices(stored), "slices")
    places = outline(cut)
    nodes = grown(materialise(local_nodes(cut.join(places, ["part", "slice"])), "nodes"), "nodes")
    tops = nodes.where(F.expr(f"level = 0 and n = 1 or level > 0 and n > power({FAN}D, level - 1) and n <= power({FAN}D, level)"))
    tops = materialise(tops.selectExpr("tree as idx", "digest"), "subroots")
    sources = tops.count()
    if not sources:
        return None
    top = materialise(grown(tops.selectExpr(f"{TOP}L as tree", "0 as level", "idx", f"{sources}L as n", "digest"), "top"), "top")
    root = bytes(top.orderBy(F.desc("level")).first()["digest"]).hex().encode()
    return Manifest(cut, places, nodes.unionByName(top), sources, root)


def fetched(m: Manifest) -> DataFrame:
    """(part, slice, nodes array<struct<tree, level, idx, digest>>): what each slice's multiproof needs from elsewhere."""
    total = m.sources

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, runs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                runs = [Run(**r) for r in runs]
                wanted = [(r.tree, level, idx) for r in runs for level, idx in missing(r.low, r.high, r.n)]
                wanted += [(TOP, level, idx) for level, idx in missing(runs[0].tree, runs[-1].tree + 1, total)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(wanted), pa.int32()), pa.array([number] * len(wanted), pa.int32()),
                     *(pa.array([w[i] for w in wanted], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int64())))], names=["part", "slice", "tree", "level", "idx"])

    wanted = m.outline.select("part", "slice", "places").mapInArrow(run, "part int, slice int, tree long, level int, idx long")
    found = wanted.join(m.nodes.select("tree", "level", "idx", "digest"), ["tree", "level", "idx"])
    return found.groupBy("part", "slice").agg(F.collect_list(F.struct("tree", "level", "idx", "digest")).alias("nodes"))


class Paths:
    """Proofs of one tree in which some nodes are known: each node's left and right siblings, and whole ways to the top."""

    def __init__(self, n: int, known: dict[int, bytes], given: dict[tuple[int, int], bytes], above: bytes = b""):
        self.widths, self.sides, self.above = widths(n), [], {}
        level = dict(known)
        for depth, width in enumerate(self.widths[:-1]):
            level |= {idx: d for (at, idx), d in given.items() if at == depth}
            sides = {}
            for parent in {i // FAN for i in known}:
                run = [level[i] for i in range(parent * FAN, min(width, (parent + 1) * FAN))]
                whole = b"".join(run)
                sides |= {parent * FAN + j: (whole[:64 * j], whole[64 * (j + 1):]) for j in range(len(run))}
            self.sides.append(sides)
            known = {parent: hashed(*(level[i] for i in range(parent * FAN, min(width, (parent + 1) * FAN)))) for parent in {i // FAN for i in known}}
            level = dict(known)
        self.top = level[0]
        self.rest = above

    def siblings(self, idx: int, depth: int = 0) -> bytes:
        """The siblings on the way from a node to the top, one after another, and those above the tree."""
        if depth == len(self.sides):
            return self.rest
        have = self.above.get((depth, idx))
        if have is None:
            left, right = self.sides[depth][idx]
            have = left + right + self.siblings(idx // FAN, depth + 1)
            if depth:  # leaves are asked for once
                self.above[depth, idx] = have
        return have

    def fold(self, idx: int, digest: bytes) -> bytes:
        """The top that a leaf's digest and its siblings give."""
        for sides in self.sides:
            left, right = sides[idx]
            digest, idx = hashed(left, digest, right), idx // FAN
        return digest


def prove(docs: DataFrame, tampered: bool = True) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row, and (place, n_leaves) in its source."""
    kinds = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, place long, n_leaves long")
    names = [c.split()[0] for c in kinds.split(", ")]
    m = build(docs, tampered)
    if m is None:
        return docs.sparkSession.createDataFrame([], kinds)
    root, total = m.root, m.sources
    joined = m.cut.join(m.outline, ["part", "slice"]).join(materialise(fetched(m), "fetched"), ["part", "slice"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, own, later, runs, nodes in zip(*(batch.column(i).to_pylist() for i in range(5))):
                runs, own, later, at = [Run(**r) for r in runs], _hex(own), _hex(later), 0
                given: dict[int, dict] = {}
                for x in nodes or ():
                    given.setdefault(x["tree"], {})[x["level"], x["idx"]] = x["digest"].hex().encode()
                trees = []
                for r in runs:
                    trees.append(Paths(r.n, dict(enumerate(own[at:at + r.high - r.low], r.low)), given.get(r.tree, {})))
                    at += r.high - r.low
                top = Paths(total, {r.tree: tree.top for r, tree in zip(runs, trees)}, given.get(TOP, {}))
                if top.top != root:
                    raise RuntimeError("a slice's multiproof doesn't lead to the root")
                rows, at = [], 0
                for r, tree in zip(runs, trees):
                    tree.rest = top.siblings(r.tree)
                    for place in range(r.low, r.high):
                        found = top.fold(r.tree, tree.fold(place, later[at]))
                        rows.append((ids[at], own[at].decode(), tree.top.decode(), root.decode(), hashed(tree.siblings(place)).decode(), found.decode(), found == root, place, r.n))
                        at += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), types)], names=names)

    types = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.int64(), pa.int64()]
    return joined.select("docs", "leaves", "folded", "places", "nodes").mapInArrow(run, kinds)


def _tree_sql(name: str, base: str, groups: str, levels: int) -> str:
    """CTEs of one tree: at each level a node's left and right siblings; a group whose one node remains stays as it is."""
    by, out = f"PARTITION BY {groups}, idx // {FAN} ORDER BY idx", ""
    for k in range(levels + 1):
        source = base if k == 0 else f"{name}{k - 1}"
        if k:
            own = f"SELECT {groups}, CASE WHEN live THEN idx // {FAN} ELSE idx END AS idx, CASE WHEN any_value(live) THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest FROM {source} GROUP BY {groups}, CASE WHEN live THEN idx // {FAN} ELSE idx END"
        else:
            own = f"SELECT {groups}, idx, digest FROM {source}"
        out += f"""
{name}{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY {groups}) > 1 AS live,
    coalesce(string_agg(digest, '') OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(digest, '') OVER ({by} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM ({own})),"""
    return out


def sql(levels: int = 5) -> str:
    """DuckDB: the trees level by level (up to ``FAN ** levels`` leaves), siblings by window frames."""
    def record(text: str) -> str:
        fields = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in (*FIELDS[:-1], text)]
        return f"sha256({' || '.join(fields)})"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # DuckDB has no crc32: bit by bit over the characters of the id
    crc = ("list_reduce(list_prepend(4294967295, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))), "
           "lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))")
    steps_tree = "".join(f"""
s{k + 1} AS (SELECT r.* REPLACE (CASE WHEN t.live THEN r.idx // {FAN} ELSE r.idx END AS idx, r.proof || CASE WHEN t.live THEN t.lft || t.rgt ELSE '' END AS proof,
    CASE WHEN t.live THEN sha256(t.lft || r.fold || t.rgt) ELSE r.fold END AS fold) FROM s{k} r JOIN tree{k} t ON r.source IS NOT DISTINCT FROM t.source AND r.idx = t.idx),""" for k in range(levels))
    steps_top = "".join(f"""
u{k + 1} AS (SELECT r.* REPLACE (CASE WHEN t.live THEN r.idx // {FAN} ELSE r.idx END AS idx, r.proof || CASE WHEN t.live THEN t.lft || t.rgt ELSE '' END AS proof,
    CASE WHEN t.live THEN sha256(t.lft || r.fold || t.rgt) ELSE r.fold END AS fold) FROM u{k} r JOIN top{k} t ON r.idx = t.idx),""" for k in range(levels))
    return f"""
WITH rows AS (SELECT doc_id, source, {record('text')} AS leaf, CASE WHEN xor({crc}, 4294967295) % {TAMPERED} = 0 THEN {record(f"translate(text, '{upper}', '{upper.lower()}')")} ELSE {record('text')} END AS later FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS digest FROM rows),{_tree_sql('tree', 'placed', 'source', levels)}
subroots AS MATERIALIZED (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, 0 AS one FROM tree{levels}),{_tree_sql('top', 'subroots', 'one', levels)}
s0 AS (SELECT doc_id, source, leaf, idx, idx AS place, later AS fold, '' AS proof FROM placed),{steps_tree}
u0 AS (SELECT s.doc_id, s.leaf, s.place, s.fold, s.proof, b.digest AS subroot, b.idx FROM s{levels} s JOIN subroots b ON s.source IS NOT DISTINCT FROM b.source),{steps_top}
root AS (SELECT digest AS root FROM top{levels})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified, place FROM u{levels}, root"""
