"""Merkle manifest of a table, built as a postorder append log.

Rows are leaves, in one tree for each value of a column, and the roots of these trees are the leaves
of a top tree. A node is the hash of its two children, or of the one that is there at the end of a level.

Builders work on aligned runs of ``WIDTH`` leaves. Each appends nodes in the order in which they
are complete, children before parents, so its log is a run of 32-byte digests without any addresses:
where a node stands follows from the sizes of the subtrees before it,

    position(level, index) = 2 e - ones(e) + level,   e = the last leaf below the node,

which is also how proofs find siblings. The tops of the runs are the leaves of the next pass, so
a tree of n leaves takes log(n) / 8 passes, each 256 times smaller than the one before.
Leaves get their places from one sort; tasks only ever hold a run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.operators.balance import written

BITS = 8
WIDTH = 1 << BITS
DIGEST = 32
#: Steps of a path: no sibling, a sibling on the left, one on the right.
ALONE, LEFT, RIGHT = 0, 1, 2
_IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id: the row within its partition

CHUNK = "tree bigint, block bigint, n bigint, top binary, log binary"
PATHS = "tree bigint, rank bigint, path binary"


def text_digest(*digests: bytes) -> bytes:
    """SHA-256 over the hexadecimal texts of digests."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def height(n: int) -> int:
    return (n - 1).bit_length()


def position(level: int, index: int, n: int) -> int:
    """Place of a node in the postorder log of a tree with ``n`` leaves."""
    last = min((index + 1) << level, n) - 1
    return 2 * last - last.bit_count() + level


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of a row: ``-`` for a null, else ``bytes:value``, numbers in decimal."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``position``, its place from 0 in the order of all rows.

    One range sort; only the number of rows of each partition goes through the driver.
    """
    stored = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()
    starts, before = [], 0
    for r in sorted(sizes, key=lambda r: r["_part"]):
        starts.append((r["_part"], before))
        before += r["n"]
    first = F.broadcast(df.sparkSession.createDataFrame(starts, "_part bigint, _before bigint"))
    placed = stored.join(first, part == F.col("_part"))
    return placed.select(*df.columns, (F.col("_before") + F.col("_at").bitwiseAND(F.lit(_IN_PARTITION))).alias("position"))


# -- the log -------------------------------------------------------------------


def _append(run: pa.Table) -> pa.Table:
    """The log of one aligned run of leaves."""
    run = run.sort_by("rank")
    first, n = run["rank"][0].as_py(), run["n"][0].as_py()
    top, log, waiting = min(BITS, height(n)), [], {}
    for e, node in enumerate(run["digest"].to_pylist(), first):
        level = 0
        while True:
            log.append(node)
            if level == top:
                break
            if e >> level & 1:
                node = text_digest(waiting[level], node)
            elif e == n - 1:
                node = text_digest(node)
            else:
                waiting[level] = node
                break
            level += 1
    return pa.table({
        "tree": pa.array([run["tree"][0].as_py()], pa.int64()), "block": pa.array([first >> BITS], pa.int64()),
        "n": pa.array([n], pa.int64()), "top": [log[-1]], "log": [b"".join(log)],
    })


def _ended() -> Column:
    """The run that holds a whole tree of its pass, and so its root."""
    return F.col("n") <= WIDTH


def append_logs(nodes: DataFrame) -> list[DataFrame]:
    """Logs of a forest, a table for each pass: ``tree, block, n, top, log``.

    ``nodes``: tree, rank (from 0 without gaps), n (leaves of the tree), digest.
    """
    passes = []
    while True:
        runs = nodes.select("tree", "rank", "n", "digest").groupBy("tree", F.shiftright("rank", BITS).alias("block"))
        logs = written(runs.applyInArrow(_append, CHUNK), "merkle-log")
        passes.append(logs)
        above = logs.where(~_ended())
        if above.isEmpty():
            return passes
        n = F.shiftright(F.col("n") + (WIDTH - 1), BITS)
        nodes = above.select("tree", F.col("block").alias("rank"), n.alias("n"), F.col("top").alias("digest"))


def roots_of(passes: list[DataFrame]) -> DataFrame:
    """``tree, root``."""
    out = None
    for logs in passes:
        found = logs.where(_ended()).select("tree", F.col("top").alias("root"))
        out = found if out is None else out.unionByName(found)
    return out


# -- proofs --------------------------------------------------------------------


def siblings(log: bytes, block: int, n: int, rank: int) -> Iterator[bytes]:
    """Steps from a leaf to the top of its run: one byte for the side, then the sibling's digest if any."""
    base = position(0, block << BITS, n)
    for level in range(min(BITS, height(n))):
        other = rank >> level ^ 1
        if other << level >= n:
            yield bytes([ALONE])
            continue
        at = DIGEST * (position(level, other, n) - base)
        yield bytes([LEFT if rank >> level & 1 else RIGHT]) + log[at:at + DIGEST]


def steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(path):
        side = path[at]
        end = at + 1 + (0 if side == ALONE else DIGEST)
        yield side, path[at + 1:end]
        at = end


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for side, other in steps(path):
        digest = text_digest(digest) if side == ALONE else (
            text_digest(other, digest) if side == LEFT else text_digest(digest, other))
    return digest


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of every leaf of a run."""
    for batch in batches:
        for r in batch.to_pylist():
            first = r["block"] << BITS
            ranks = range(first, min(first + WIDTH, r["n"]))
            paths = [b"".join(siblings(r["log"], r["block"], r["n"], i)) + r["path"] for i in ranks]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["tree"]] * len(ranks), pa.int64()), pa.array(ranks, pa.int64()), pa.array(paths, pa.binary())],
                names=["tree", "rank", "path"])


def _with_rest(passes: list[DataFrame], rest: DataFrame) -> DataFrame:
    """The runs of the first pass with ``path``, the way from their top to the end.

    ``rest`` (tree, path) is the way on from each tree's root.
    """
    carried = None
    for logs in reversed(passes):
        path = logs.where(_ended()).select("tree", "block").join(rest, "tree").select("tree", "block", "path")
        if carried is not None:
            path = path.unionByName(carried)
        runs = logs.join(path, ["tree", "block"])
        if logs is passes[0]:
            return runs
        carried = runs.mapInArrow(_spread, PATHS).withColumnRenamed("rank", "block")


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``key, group, leaf, altered, tree, rank, n``; ``trees``: ``group, tree, n, subroot``;
    the logs of all trees and of the top tree; the root, None for an empty table."""

    leaves: DataFrame
    trees: DataFrame
    passes: list[DataFrame]
    top_passes: list[DataFrame]
    root: bytes | None


def manifest(rows: DataFrame) -> Manifest:
    """Build the logs of ``rows``: ``key, group, leaf, altered``.

    Trees hold the leaves of one group by ascending key (null first; equal keys by leaf); the top
    tree holds the roots by group, null first. ``altered`` is carried along.
    """
    stored = written(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    placed = written(numbered(stored, ["group", "key", "leaf", "_row"]).drop("_row"), "placed-leaves")
    groups = placed.groupBy("group").agg(F.count("*").alias("n"), F.min("position").alias("_first"))
    groups = written(numbered(groups, ["group"]).withColumnRenamed("position", "tree"), "trees")
    g = groups.withColumnRenamed("group", "_group")
    leaves = placed.join(g, F.col("group").eqNullSafe(F.col("_group"))).select(
        "key", "group", "leaf", "altered", "tree", (F.col("position") - F.col("_first")).alias("rank"), "n")
    passes = append_logs(leaves.withColumnRenamed("leaf", "digest"))
    trees = written(groups.join(roots_of(passes), "tree").select(
        "group", "tree", "n", F.col("root").alias("subroot")), "subroots")
    tops = trees.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("rank"),
                        F.lit(trees.count()).cast("bigint").alias("n"), F.col("subroot").alias("digest"))
    top_passes = append_logs(tops)
    root = roots_of(top_passes).first()
    return Manifest(leaves, trees, passes, top_passes, None if root is None else bytes(root["root"]))


PROOFS = "key bigint, tree bigint, leaf binary, proof_sha256 string, folded_root binary"


def _prove(keys: pa.Table, run: pa.Table) -> pa.Table:
    """Proofs of the leaves of one run, and what the leaf or its altered form folds to."""
    r = run.to_pylist()[0]
    proof, folded = [], []
    for leaf in keys.to_pylist():
        path = b"".join(siblings(r["log"], r["block"], r["n"], leaf["rank"])) + r["path"]
        others = "".join(d.hex() for side, d in steps(path) if side != ALONE)
        proof.append(hashlib.sha256(others.encode()).hexdigest())
        folded.append(fold(leaf["leaf"] if leaf["altered"] is None else leaf["altered"], path))
    return pa.table({
        "key": keys["key"], "tree": keys["tree"], "leaf": keys["leaf"],
        "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.binary()),
    })


def proofs(made: Manifest) -> DataFrame:
    """``key, tree, leaf, proof_sha256, folded_root`` of every leaf."""
    nothing = F.lit(b"")
    top = _with_rest(made.top_passes, made.top_passes[-1].where(_ended()).select("tree", nothing.alias("path")))
    rest = top.mapInArrow(_spread, PATHS).select(F.col("rank").alias("tree"), "path")
    runs = _with_rest(made.passes, rest).select("tree", "block", "n", "log", "path")
    block = F.shiftright("rank", BITS)
    mine = made.leaves.select("tree", block.alias("block"), "rank", F.col("key").cast("bigint").alias("key"), "leaf", "altered")
    return mine.groupBy("tree", "block").cogroup(runs.groupBy("tree", "block")).applyInArrow(_prove, PROOFS)


ENTRIES = "tree bigint, position bigint, level int, index bigint, digest binary"


def log_entries(made: Manifest) -> DataFrame:
    """The whole log, a row for each node: ``tree, position, level, index, digest``, with its place in
    the postorder of its tree."""

    def entries(below: int):
        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    out, at, n = [], 0, r["n"]
                    first = r["block"] << BITS
                    for e in range(first, min(first + WIDTH, n)):
                        level, more = 0, True
                        while more:
                            if level or not below:  # the leaves of a later pass are in the log of the one before
                                whole, index = below * BITS + level, e >> level
                                out.append((r["tree"], position(whole, index, r["leaves"]), whole, index,
                                            r["log"][at:at + DIGEST]))
                            at += DIGEST
                            more = level < min(BITS, height(n)) and (e >> level & 1 or e == n - 1)
                            level += 1
                    names = [f.split()[0] for f in ENTRIES.split(", ")]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], names=names)
        return expand

    sizes = made.trees.select("tree", F.col("n").alias("leaves"))
    out = None
    for below, logs in enumerate(made.passes):
        found = logs.join(sizes, "tree").mapInArrow(entries(below), ENTRIES)
        out = found if out is None else out.unionByName(found)
    return out


def document_manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, a row for each document.

    A tree for each ``lang``. Rows with equal ids stand in the order of their leaf hashes and equal rows
    next to each other, each with its own proof; null ids come first. A null ``lang`` is a tree of its own.
    Where 7 divides the CRC-32 of the id, the folded leaf has ``n_chars`` plus one; a null ``n_chars`` or id
    is not tampered with. Other columns do not matter. An empty table gives no rows.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    columns = [F.col(c) for c in fields]
    hit = (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0) & F.col("n_chars").isNotNull()
    more = [F.col(c).cast("bigint") + 1 if c == "n_chars" else F.col(c) for c in fields]
    made = manifest(docs.select(
        F.col("doc_id").alias("key"), F.col("lang").alias("group"), row_digest(columns).alias("leaf"),
        F.when(hit, row_digest(more)).alias("altered")))
    if made.root is None:
        return docs.sparkSession.createDataFrame([], (
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, "
            "proof_sha256 string, folded_root string, verified boolean"))
    shown = lambda c: F.lower(F.hex(c)).alias(c)
    root = F.lit(made.root)
    found = proofs(made).join(made.trees.select("tree", "subroot"), "tree")
    return found.select(
        F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), shown("leaf"), shown("subroot"),
        F.lower(F.hex(root)).alias("root"), "proof_sha256", shown("folded_root"),
        (F.col("folded_root") == root).alias("verified"))


def sql() -> str:
    """The same rows in SQL: levels by repeated grouping, folds along the siblings."""
    def digest(n_chars: str) -> str:
        parts = [f"COALESCE(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                 for c in ("doc_id", "source", "lang", n_chars, "text")]
        return f"sha256({' || '.join(parts)})"

    # CRC-32 bit by bit: each byte is mixed in and followed by eight shifts
    crc = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda x, o: CASE WHEN o < 0 THEN xor(x >> 1, 3988292384 * (x & 1)) ELSE xor(x, o) END), 4294967295)"""

    def levels(name: str, start: str) -> str:
        return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 2)"""

    def folds(name: str, start: str, levels_of: str) -> str:
        return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT f.row, f.tree, f.level + 1, f.idx // 2,
         CASE WHEN s.digest IS NULL THEN sha256(f.digest) WHEN f.idx % 2 = 1 THEN sha256(s.digest || f.digest)
              ELSE sha256(f.digest || s.digest) END,
         f.proof || COALESCE(s.digest, '')
  FROM {name} f JOIN {levels_of} me ON me.tree = f.tree AND me.level = f.level AND me.idx = f.idx AND me.n > 1
  LEFT JOIN {levels_of} s ON s.tree = f.tree AND s.level = f.level AND s.idx = xor(f.idx, 1))"""

    return f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, lang, row_number() OVER () AS row, {digest('n_chars')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND {crc} % 7 = 0
              THEN {digest('(CAST(n_chars AS BIGINT) + 1)')} END AS altered
  FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS rnk,
         count(*) OVER (PARTITION BY lang) AS n
  FROM rows_),
{levels('low', 'SELECT tree, 0 AS level, rnk AS idx, leaf AS digest, n FROM placed').strip()},
subroots AS (SELECT tree, digest FROM low WHERE n = 1),
{levels('high', '''SELECT 0 AS tree, 0 AS level, tree AS idx, digest, (SELECT count(*) FROM subroots) AS n
  FROM subroots''').strip()},
{folds('low_fold', '''SELECT row, tree, 0 AS level, rnk AS idx, COALESCE(altered, leaf) AS digest, '' AS proof
  FROM placed''', 'low').strip()},
low_end AS (SELECT row, tree, digest, proof FROM low_fold
            QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1),
{folds('high_fold', '''SELECT row, 0 AS tree, 0 AS level, tree AS idx, digest, proof
  FROM low_end''', 'high').strip()},
ends AS (SELECT row, digest, proof FROM high_fold
         QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
       e.digest AS folded_root, e.digest = r.digest AS verified
FROM placed p JOIN ends e USING (row) JOIN subroots s ON s.tree = p.tree
CROSS JOIN (SELECT digest FROM high WHERE n = 1) r"""
