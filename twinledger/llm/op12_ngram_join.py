"""Documents whose sets of five-word shingles overlap by a Jaccard similarity of 0.8 or more.

T-occurrence search by DivideSkip. A document of n shingles needs at least T = ceil(0.8 n) of them in any
partner, so its lists fall into n - T + 1 short ones, of which a partner must be in one at least, and T - 1
long ones. Short lists are merged with a heap, which counts how often each document occurs; a document
that can still reach the required overlap is probed in the long lists by binary search.

Lists are told apart by one order of all shingles: those of few documents first, by hash, and those
of more than ``BLOCK`` documents last. So a passage that very many documents share is in long lists only,
unless they have little else.

Lists may still be long where very many documents are near copies. Documents with equal sets are one
class. Of each list, all members are first probed against two pivots, which joins near copies to
components; then the lists with more than one component are searched in blocks of ``BLOCK`` members,
across components only. So no link between components is lost, and nothing is listed pair by pair.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.components import components
from twinledger.llm.textvec import Chunk, chunks, mix, windows
from twinledger.operators.balance import small_enough, written
from twinledger.session import delete, shuffles_removed

K = 5
#: Members of a list that are searched together.
BLOCK = 256
#: Common shingles that the order knows; of more, those of most documents.
COMMON = 1_000_000
#: Only the shingles with the smallest hashes are counted, since others come into a short list only
#: if over half of a document is common. The order of the rest is by hash alone; results are the same.
COUNTED = int(0.4 * (1 << 63))
PAIRS_AT_ONCE = 256
MARK_BITS = 1024
_KEY = np.uint64((1 << 63) - 1)
_LAST = np.uint64(1 << 63)


def required(n_a: int, n_b: int) -> int:
    """The least overlap of two linked sets: 100 i >= 80 (n_a + n_b - i)."""
    return (4 * (n_a + n_b) + 8) // 9


def n_short(n):
    """How many lists of a set of n shingles are short: n - ceil(0.8 n) + 1."""
    return n - (4 * n + 4) // 5 + 1


# -- sets ----------------------------------------------------------------------


def shingle_sets(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Owner and 63-bit key of each distinct shingle of a chunk, in this order."""
    upper = (c.data >= 65) & (c.data <= 90)
    c = Chunk(c.lo, c.hi, c.data + (upper * np.uint8(32)), c.at)
    s, e = c.words()
    owner, word = c.owner(s), c.fingerprints(s, e)
    gram, at = windows(word, owner, K)
    holder = owner[at]
    n = np.bincount(owner, minlength=c.docs)
    few = np.flatnonzero((n > 0) & (n < K))
    if len(few):  # fewer words are one shingle
        first = np.searchsorted(owner, few)
        whole = np.zeros(len(few), np.uint64)
        for j in range(K - 1):
            there = j < n[few]
            whole[there] = mix(whole[there] + word[first[there] + j] + np.uint64(j + 1))
        holder, gram = np.concatenate((holder, few)), np.concatenate((gram, mix(whole ^ n[few].astype(np.uint64))))
    key = gram & _KEY
    order = np.lexsort((key, holder))
    holder, key = holder[order], key[order]
    new = np.concatenate(([True], (holder[1:] != holder[:-1]) | (key[1:] != key[:-1]))) if len(key) else np.zeros(0, bool)
    return holder[new], key[new]


def _class_keys(holder: np.ndarray, key: np.ndarray, docs: int) -> pa.Array:
    """128 bits for each set, null for an empty one."""
    words = np.zeros((docs, 2), np.uint64)
    for i, seed in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        np.add.at(words[:, i], holder, mix(key ^ np.uint64(seed)))
    none = np.bincount(holder, minlength=docs) == 0
    return pa.array([None if x else w.tobytes() for x, w in zip(none.tolist(), words)], pa.binary())


def _lists(holder: np.ndarray, values: np.ndarray, docs: int) -> pa.Array:
    ends = np.searchsorted(holder, np.arange(docs + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _marks(holder: np.ndarray, key: np.ndarray, docs: int) -> pa.Array:
    """``MARK_BITS`` bits for each set: whether an odd number of its keys falls on the bit. Two sets differ in at
    least as many keys as their marks in bits."""
    words = np.zeros((docs, MARK_BITS // 64), np.uint64)
    np.bitwise_xor.at(words, (holder, ((key >> np.uint64(6)) % np.uint64(MARK_BITS // 64)).astype(np.int64)),
                      np.uint64(1) << (key & np.uint64(63)))
    ends = np.arange(docs + 1, dtype=np.int32) * (MARK_BITS // 64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(words.reshape(-1).view(np.int64)))


KEYED_TYPE = "struct<n_shingles:bigint,class:binary,marks:array<bigint>,keys:array<bigint>>"


def shingle_keys(text: str | Column, common: np.ndarray | None = None) -> Column:
    """Set size, class, and keys of a text: the counted ones, or, given the common keys, those of its
    short lists, with the highest bit set in common ones."""

    @F.arrow_udf(KEYED_TYPE)
    def keyed(texts: pa.Array) -> pa.Array:
        parts = []
        for c in chunks(texts):
            holder, key = shingle_sets(c)
            n = np.bincount(holder, minlength=c.docs)
            name, marks = _class_keys(holder, key, c.docs), _marks(holder, key, c.docs)
            if common is None:
                some = key < np.uint64(COUNTED)
                keys = _lists(holder[some], key[some], c.docs)
            else:
                if len(common):
                    at = np.minimum(np.searchsorted(common, key), len(common) - 1)
                    key = np.where(common[at] == key, key | _LAST, key)
                order = np.lexsort((key, holder))
                holder, key = holder[order], key[order]
                rank = np.arange(len(key)) - np.searchsorted(holder, np.arange(c.docs))[holder]
                some = rank < n_short(n)[holder]
                keys = _lists(holder[some], key[some], c.docs)
            parts.append(pa.StructArray.from_arrays(
                [pa.array(n.astype(np.int64)), name, marks, keys], names=["n_shingles", "class", "marks", "keys"]))
        if not parts:
            return pa.array([], pa.struct([("n_shingles", pa.int64()), ("class", pa.binary()),
                                          ("marks", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))]))
        return pa.concat_arrays(parts)

    return keyed(text)


def _common_keys(shared: DataFrame, limit: int = COMMON) -> np.ndarray:
    """Sorted keys of more than ``BLOCK`` documents; if these are too many, of the next power of two that fits."""
    least = BLOCK + 1
    hot = shared.where(F.col("n") >= least)
    while not small_enough(hot, limit):
        least *= 2
        hot = hot.where(F.col("n") >= least)
    return np.sort(hot.select("key").toPandas()["key"].to_numpy(np.int64).view(np.uint64))


# -- probing -------------------------------------------------------------------

_PAIR = "a bigint, b bigint"


def _frame(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def probe(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the overlap of two sorted sets: each key of the smaller one is looked up in the other."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with their texts those that are linked."""
    for batch in batches:
        for lo in range(0, batch.num_rows, PAIRS_AT_ONCE):
            part = batch.slice(lo, PAIRS_AT_ONCE)
            a, b = part["a"].to_pylist(), part["b"].to_pylist()
            where = {}
            for i, x in enumerate(a + b):
                where.setdefault(x, i)
            texts = pa.concat_arrays([part["text_a"], part["text_b"]]).take(pa.array(list(where.values())))
            sets = {}
            names = list(where)
            for c in chunks(texts):
                holder, key = shingle_sets(c)
                ends = np.searchsorted(holder, np.arange(c.docs + 1))
                for i in range(c.docs):
                    sets[names[c.lo + i]] = key[ends[i]:ends[i + 1]]
            yield _frame([(x, y) for x, y in zip(a, b)
                          if probe(sets[x], sets[y]) >= required(len(sets[x]), len(sets[y]))])


def _links(pairs: DataFrame, texts: DataFrame, key: Column, classes: DataFrame) -> DataFrame:
    """The linked ones of the stored pairs ``a, b``; only the texts of their classes are fetched, one of each."""
    needed = pairs.select(F.col("a").alias("no")).union(pairs.select("b")).distinct()
    needed = written(classes.select("no", "class", "least_id").join(needed, "no"), "needed-classes")
    # only texts with a needed id, or none, are parsed for their class: rows may share an id
    ids = needed.select(F.col("least_id").alias("_id")).where("_id IS NOT NULL").distinct()
    # stored, since the planner would filter by the class, and so parse all texts, below the join
    rows: list[str] = []
    some = written(texts.join(ids, "_id", "left_semi").union(texts.where("_id IS NULL")), "needed-rows", rows)
    found = some.select("_id", "text", key["class"].alias("class")).join(needed, "class").where(
        F.col("_id").eqNullSafe(F.col("least_id"))).groupBy("no").agg(F.first("text").alias("text"))
    found = written(found, "needed-texts")
    delete(texts.sparkSession, *rows)
    one = found.select(F.col("no").alias("b"), F.col("text").alias("text_b"))
    other = found.select(F.col("no").alias("a"), F.col("text").alias("text_a"))
    linked = pairs.join(one, "b").join(other, "a").select("a", "b", "text_a", "text_b").mapInArrow(_probed, _PAIR)
    return written(linked, "links")


# -- searching across components ----------------------------------------------


def search(members: list[dict], of: int, across: bool = False) -> list[tuple[int, int]]:
    """Pairs of members of the list ``of``, in different components, that can reach the required overlap.

    ``members``: no, n, component, side, keys in the order of all shingles, and ``at``: the place of each key
    in the member's shingles. Keys that no other member has may be left out. With ``across`` only pairs of
    different sides. The lists of the members before are merged. A pair that an earlier list holds too
    was searched there.
    """
    members = sorted(members, key=lambda m: (m["n"], m["no"]))
    sizes = [m["n"] for m in members]
    lists: dict[int, list[int]] = {}
    found = []
    for at, m in enumerate(members):
        least = bisect_left(sizes, (4 * m["n"] + 4) // 5)  # members before have too few shingles
        new = {before for before in range(least, at) if members[before]["component"] != m["component"]
               and (not across or members[before]["side"] != m["side"]) and _alike(m, members[before])}
        keys = iter(m["keys"])
        for key in keys:
            if key == of or not new:
                break
            new.difference_update(lists.get(key, ()))
        if new:
            short = [[before for before in lists[key] if before in new] for key in chain((of,), keys) if key in lists]
            for other, times in groupby(heapq.merge(*short)):
                if _reaches(m, members[other], sum(1 for _ in times)):
                    found.append((members[other]["no"], m["no"]))
        for key in m["keys"]:
            lists.setdefault(key, []).append(at)
    return found


def _alike(a: dict, b: dict) -> bool:
    """Marks that differ in more bits than linked sets do in keys rule a pair out."""
    return (a["marks"] ^ b["marks"]).bit_count() <= a["n"] + b["n"] - 2 * required(a["n"], b["n"])


def _reaches(a: dict, b: dict, times: int) -> bool:
    """Can the long lists still give what is missing? The shorter of both ways to the end bounds it."""
    rest = max(a["n"] - n_short(a["n"]), b["n"] - n_short(b["n"]))
    needed = required(a["n"], b["n"]) - times
    if rest < needed:
        return False
    x, y = a["at"], b["at"]
    last = max((key for key in x if key in y), key=x.__getitem__)
    return min(a["n"] - x[last], b["n"] - y[last]) - 1 >= needed


def _search_block(block: pa.Table) -> pa.Table:
    columns = block.select(["no", "n", "component", "mine", "first", "second"]).to_pylist()
    lists = block["keys"].combine_chunks()
    ends = lists.offsets.to_numpy()
    key, place = lists.flatten().to_numpy(), block["places"].combine_chunks().flatten().to_numpy()
    # most keys are of members outside of this list
    _, of, times = np.unique(key, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[of] > 1)
    key, place, bounds = key[shared].tolist(), place[shared].tolist(), np.searchsorted(shared, ends - ends[0]).tolist()
    marks = block["marks"].combine_chunks().flatten().to_numpy().tobytes()
    members = [m | {"side": m["mine"] == m["first"], "marks": int.from_bytes(marks[i * MARK_BITS // 8:(i + 1) * MARK_BITS // 8]), "keys": key[lo:hi], "at": dict(zip(key[lo:hi], place[lo:hi]))}
               for i, (m, lo, hi) in enumerate(zip(columns, bounds[:-1], bounds[1:]))]
    across = members[0]["first"] != members[0]["second"]
    return pa.Table.from_batches([_frame(search(members, block["list"][0].as_py(), across))])


def _listed(rows: DataFrame) -> DataFrame:
    """``no, n, keys, places`` of each class, in the order of its shingles."""
    listed = rows.groupBy("no").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "key"))).alias("_l"))
    return listed.select("no", "n", F.col("_l.key").alias("keys"), F.col("_l.place").alias("places"))


def _candidates(rows: DataFrame, label: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs of different components that a list and the lengths do not rule out."""
    name = F.coalesce(F.col("component"), F.col("no"))
    rows = rows.join(label.withColumnRenamed("node", "no"), "no", "left").withColumn("component", name)
    value = F.xxhash64("no")
    lists = rows.groupBy("key").agg(
        F.count("*").alias("size"), F.bit_xor(value).alias("x"), F.sum(F.shiftright(value, 24)).alias("s"),
        F.min("component").alias("low"), F.max("component").alias("high"))
    # lists of one component hold no pair that is looked for, so they do not count either
    lists = written(lists.where("low <> high").drop("low", "high"), "open-lists")
    rows = written(rows.join(lists.select("key"), "key"), "open-rows")
    # two pivots have met all members of lists of three; of lists with the same members the first is searched
    once = lists.where("size > 3").groupBy("size", "x", "s").agg(
        F.min(F.struct(F.shiftrightunsigned("key", 63), "key"))["key"].alias("key"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("no", F.lit(7)), F.col("blocks")).cast("int")
    found = rows.join(once.select("key", blocks.alias("blocks")), "key").withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    found = found.select("key", "no", "component", "mine", other).select(
        F.col("key").alias("list"), "no", "component", "mine",
        F.least("mine", "other").alias("first"), F.greatest("mine", "other").alias("second"))
    return found.join(_listed(rows), "no").join(marks, "no").groupBy("list", "first", "second").applyInArrow(_search_block, _PAIR).distinct()


def _possible(pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that are in enough short lists together to reach the required overlap."""
    one, other = (listed.select(F.col("no").alias(x), F.col("n").alias(f"n_{x}"), F.col("keys").alias(f"keys_{x}"), F.col("marks").alias(f"marks_{x}"))
                  for x in "ab")
    met = F.size(F.array_intersect("keys_a", "keys_b"))
    rest = F.greatest(*[F.floor((4 * F.col(n) + 4) / 5) - 1 for n in ("n_a", "n_b")])
    needed = F.floor((4 * (F.col("n_a") + F.col("n_b")) + 8) / 9)
    bits = F.aggregate(F.zip_with("marks_a", "marks_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    alike = bits <= F.col("n_a") + F.col("n_b") - 2 * needed
    return pairs.join(one, "a").join(other, "b").where((met + rest >= needed) & alike).select("a", "b")


# -- the join ------------------------------------------------------------------


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id``, a row for each row of ``docs``.

    ``component_id`` is the smallest id that links lead to. Rows with equal ids and different texts are
    documents of their own; null ids count only where a component has no other. A null text, or one without
    words, has no shingles and its own id. Other columns do not matter.
    """
    with shuffles_removed(docs.sparkSession):
        return _joined(docs, id_col, text_col)


def _joined(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    gone: list[str] = []  # folders that nothing after the short lists reads
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    shared = written(texts.select(F.explode(shingle_keys("text")["keys"]).alias("key")).groupBy("key").agg(
        F.count("*").alias("n")).where("n > 1"), "shared-keys", gone)
    k = shingle_keys("text", _common_keys(shared)).alias("_k")
    whole = written(texts.select("_id", k).select("_id", "_k.*"), "shingle-keys", gone)
    listed = whole.where("n_shingles > 0").groupBy("class").agg(
        F.min("_id").alias("least_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
        F.first("marks").alias("marks"))
    listed = written(listed.withColumn("no", F.monotonically_increasing_id()), "listed-classes", gone)
    keyed = written(whole.select("_id", "n_shingles", "class"), "classes-of-rows")
    classes = written(listed.select("no", "class", "least_id"), "classes")

    lists = listed.select("no", "n", F.posexplode("keys").alias("place", "key"))
    plain = F.col("key").bitwiseAND(F.lit((1 << 63) - 1))
    counted = lists.where(plain < COUNTED).join(
        shared.select(F.col("key").alias("_shared")), plain == F.col("_shared"), "left_semi")
    used: list[str] = []  # folders that only the search reads
    rows = written(counted.unionByName(lists.where(plain >= COUNTED)), "short-lists", used)
    listed = written(_listed(rows).join(listed.select("no", "marks"), "no"), "listed", used)
    marks = listed.select("no", "marks")
    for path in gone:
        delete(spark, path)

    order = F.struct(F.xxhash64("no", F.lit(3)).alias("h"), "no", "n")
    pivots = rows.groupBy("key").agg(F.count("*").alias("size"), F.min(order).alias("p"), F.max(order).alias("q"))
    pivots = pivots.where("size > 1").select("key", F.explode(F.array("p", "q")).alias("p"))
    pairs = rows.join(pivots, "key").where(
        (F.col("no") != F.col("p.no")) & (5 * F.least("n", "p.n") >= 4 * F.greatest("n", "p.n")))
    pairs = pairs.select(F.least("p.no", "no").alias("a"), F.greatest("p.no", "no").alias("b")).distinct()
    links = _links(written(_possible(pairs, listed), "pivot-pairs"), texts, k, classes)

    candidates = written(_candidates(rows, components(links), marks), "candidates")
    for path in used:
        delete(spark, path)
    links = links.unionByName(_links(candidates, texts, k, classes))
    label = components(links)
    least = classes.select("no", "least_id").join(label.withColumnRenamed("node", "no"), "no").groupBy("component").agg(
        F.min("least_id").alias("component_id"))
    joined = label.join(least, "component").select(F.col("node").alias("no"), "component_id")
    named = classes.join(joined, "no", "left").select("class", F.when(
        F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id"))
    return keyed.select("_id", "n_shingles", "class").join(named, "class", "left").select(
        F.col("_id").alias(id_col), "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"))


def sql() -> str:
    """The same rows in SQL: all pairs of classes that share a shingle."""
    letters = "".join(map(chr, range(65, 91)))
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(COALESCE(text, ''), '{letters}', '{letters.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, row, list_sort(list_distinct(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {K} THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - {K - 2}), lambda i: array_to_string(w[i:i + {K - 1}], ' ')) END)) AS s
  FROM words),
classes AS (SELECT s, row_number() OVER () AS c, min(doc_id) AS least FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT c, len(s) AS n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.c AS a, b.c AS b FROM grams a JOIN grams b ON a.g = b.g AND a.c <> b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
found AS (SELECT r.a, min(k.least) AS component_id FROM reach r JOIN classes k ON k.c = r.b GROUP BY r.a)
SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles,
       CASE WHEN len(t.s) > 0 THEN f.component_id ELSE t.doc_id END AS component_id
FROM sets t LEFT JOIN classes k ON k.s = t.s LEFT JOIN found f ON f.a = k.c"""
