"""Near-duplicate documents by order MinHash, verified by banded alignment.

A k-mer is five or three words together with how often it occurred before. Each sketch takes the two
k-mers with the smallest hash and keeps them in text order, so equal sketches speak for a small edit
distance and not only for shared words. Documents that share a sketch are candidates; a pair is a
link if its word edit distance, from a banded alignment, is at most a fifth of the longer text.

Where a fifth of the words differ, few five-word k-mers are left, so most sketches are of three words.
Short texts have too few k-mers for sketches: they are candidates if they share any three words in a
row (two, up to five words), which all pairs within the limit do, since edits cut the longer text into
one piece more than there are edits.

Groups may be huge, so their members are aligned with the bucket's first document only. What that
leaves apart is compared in blocks of bounded size by signatures (length, keys, word histogram), which
rule out almost all pairs of unlike documents. A document's signature is joined once, to the list of its
buckets; blocks of large buckets hold texts of like length and meet only blocks of the lengths next to theirs.
Texts are fetched only for pairs that are left and in components of their own, first one pair for each
document, then what that has not connected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.components import components
from twinledger.llm.textvec import chunks, mix, occurrence, windows
from twinledger.operators.balance import written
from twinledger.session import delete, shuffles_removed

K = 5
KEPT = 2  # k-mers in a sketch
SKETCHES = 16
#: Sketches of shorter k-mers, for pairs at the limit: of texts of 48 and more words where a fifth of the
#: words is replaced, all but 0.0008 share one.
CLOSE_K = 3
CLOSE_SKETCHES = 64
#: Texts of at most so many words have all their short k-mers as keys; 5/4 of 48.
SHORT = 60
SIMILARITY = 0.8
#: Documents of a bucket in one block of signatures, under 5 KB each.
BLOCK = 2048
BINS = 128
#: Bins of a signature; folded to fewer, they decide on most pairs.
FINE_BINS = 4096
FOLDS = (BINS, 1024, FINE_BINS)

SKETCH_TYPE = "struct<n:int,keys:array<bigint>>"
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sketches(c, sketches: int, k: int, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Word counts, and sketch values (documents x sketches) of a chunk."""
    s, e = c.words()
    owner, word = c.owner(s), c.fingerprints(s, e)
    n = np.bincount(owner, minlength=c.docs)
    gram, at = windows(word, owner, k)
    holder = owner[at]
    # a text of fewer words has one k-mer: all of it
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        first = np.searchsorted(owner, short)
        value = np.array([np.bitwise_xor.reduce(mix(word[f:f + m] + np.arange(m, dtype=np.uint64)))
                          for f, m in zip(first, n[short])], np.uint64)
        gram = np.concatenate((gram, value))
        holder = np.concatenate((holder, short))
        order = np.argsort(holder, kind="stable")
        gram, holder = gram[order], holder[order]
    out = np.zeros((c.docs, sketches), np.uint64)
    if not len(gram):
        return n, out
    seen, _ = occurrence(gram, holder)
    label = mix(gram + mix(seen.astype(np.uint64) + np.uint64(77)))
    starts = np.flatnonzero(np.concatenate(([True], holder[1:] != holder[:-1])))
    sizes = np.diff(np.append(starts, len(gram)))
    docs, row = holder[starts], np.repeat(np.arange(len(starts)), sizes)
    for i in range(sketches):
        seed = mix(np.uint64([2 * i + 1, 2 * i + 2]))
        value = (label ^ seed[0]) * (seed[1] | np.uint64(1))
        picked = np.full((kept, len(starts)), len(gram), np.int64)
        for j in range(kept):
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == np.repeat(least, sizes))
            which = row[hit]
            first = np.concatenate(([True], which[1:] != which[:-1]))
            which, hit = which[first], hit[first]
            there = least[which] != _MAX  # fewer k-mers than asked for
            picked[j, which[there]] = hit[there]
            value[hit] = _MAX
        picked.sort(axis=0)
        key = np.full(len(starts), (k << 32) + i + 1, np.uint64)
        padded = np.append(gram, np.uint64(0))
        for j in range(kept):
            key = mix(key * np.uint64(0xA24BAED4963EE407) + padded[picked[j]])
        out[docs, i] = key
    return n, out


def _short_keys(c, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and value of each distinct run of three words of the short texts of a chunk, of two words up to five."""
    s, e = c.words()
    owner = c.owner(s)
    few = n[owner] <= SHORT
    owner, word = owner[few], c.fingerprints(s[few], e[few])
    found = []
    for k, least, most in ((2, 4, 5), (3, 5, SHORT)):
        gram, at = windows(word, owner, k)
        holder = owner[at]
        ok = (n[holder] >= least) & (n[holder] <= most)
        found.append((holder[ok], mix(gram[ok] ^ np.uint64(0x5851F42D4C957F2D + k))))
    holder, key = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((key, holder))
    holder, key = holder[order], key[order]
    new = np.concatenate(([True], (holder[1:] != holder[:-1]) | (key[1:] != key[:-1]))) if len(key) else np.zeros(0, bool)
    return holder[new], key[new]


def order_sketches(text: str | Column, sketches: int = SKETCHES, k: int = K, kept: int = KEPT) -> Column:
    """Struct of the number of words and the sketch values; no values for a text without words."""

    @F.arrow_udf(SKETCH_TYPE)
    def made(texts: pa.Array) -> pa.Array:
        counts, values = [np.zeros(0, np.int64)], [np.zeros((0, sketches), np.uint64)]
        for c in chunks(texts):
            n, v = _sketches(c, sketches, k, kept)
            counts.append(n)
            values.append(v)
        n, v = np.concatenate(counts), np.concatenate(values)
        some = n > 0
        offsets = np.concatenate(([0], np.cumsum(np.where(some, sketches, 0)))).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(v[some].reshape(-1).view(np.int64)))
        return pa.StructArray.from_arrays([pa.array(n.astype(np.int32)), keys], names=["n", "keys"])

    return made(text)


def candidate_keys(text: str | Column) -> Column:
    """Struct of the number of words and the keys: sketches of both k, then those of a short text."""

    @F.arrow_udf(SKETCH_TYPE)
    def made(texts: pa.Array) -> pa.Array:
        counts, values, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for c in chunks(texts):
            n, v = _sketches(c, SKETCHES, K, KEPT)
            _, w = _sketches(c, CLOSE_SKETCHES, CLOSE_K, KEPT)
            holder, short = _short_keys(c, n)
            some = np.flatnonzero(n > 0)
            sketch = np.hstack((v[some], w[some]))
            holder = np.concatenate((np.repeat(some, sketch.shape[1]), holder))
            order = np.argsort(holder, kind="stable")
            counts.append(n)
            values.append(np.concatenate((sketch.reshape(-1), short))[order])
            sizes.append(np.bincount(holder, minlength=c.docs))
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).view(np.int64)))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(counts).astype(np.int32)), keys], names=["n", "keys"])

    return made(text)


def word_values(text: str | Column) -> Column:
    """The words of a text as packed 32-bit values, for alignment."""

    @F.arrow_udf("binary")
    def made(texts: pa.Array) -> pa.Array:
        out = []
        for c in chunks(texts):
            s, e = c.words()
            value = (c.fingerprints(s, e) & np.uint64(0x7FFFFFFF)).astype("<i4")
            cuts = np.searchsorted(c.owner(s), np.arange(c.docs + 1))
            out += [value[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        return pa.array(out, pa.binary())

    return made(text)


def allowed(n: int, m: int, similarity: float = SIMILARITY) -> int:
    """Most edits between texts of n and m words that still are similar enough."""
    return int((1 - similarity) * max(n, m) + 1e-9)


def banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two arrays, or -1 if it is more than ``limit``.

    Equal ends are cut off; then only cells near the diagonal are filled, in bands that widen until
    the distance fits into one.
    """
    if abs(len(a) - len(b)) > limit:
        return -1
    m = min(len(a), len(b))
    same = a[:m] == b[:m]
    head = m if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    m = min(len(a), len(b))
    if m:
        same = a[::-1][:m] == b[::-1][:m]
        tail = m if same.all() else int(np.argmin(same))
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        longest = max(len(a), len(b))
        return longest if longest <= limit else -1
    band = max(64, abs(len(a) - len(b)))
    while True:
        band = min(band, limit)
        found = _in_band(a, b, band)
        if found <= band:
            return found
        if band >= limit:
            return -1
        band *= 4


def _in_band(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance if it is at most ``band``, else something larger.

    The differences between the cells of a column near the diagonal are the bits of two integers, so a
    column takes a few operations whatever the width of the band.
    """
    if len(a) < len(b):
        a, b = b, a
    band = min(band, len(a))
    places: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    # the highest bit is the lowest cell of the band; it goes down with the diagonal, then along the last row
    width = 2 * band + 1
    every, lowest = (1 << width) - 1, 1 << (width - 1)
    up, down = every ^ ((1 << band) - 1), 0
    score, shift, corner = band, -band, len(a) - band
    most = band + len(b) - corner  # it falls by one at most on each step along the last row
    for j, word in enumerate(b.tolist()):
        same = places.get(word, 0)
        same = (same << -shift if shift < 0 else same >> shift) & every
        diagonal = ((((same & up) + up) ^ up) | same | down) & every
        right, left = down | every ^ (diagonal | up), diagonal & up
        if j < corner:
            score += not diagonal & lowest
        else:
            lowest >>= 1
            score += bool(right & lowest) - bool(left & lowest)
        if score > most:
            return band + 1
        diagonal >>= 1
        up, down = left | every ^ (diagonal | right), diagonal & right
        shift += 1
    return score


def histogram(words: np.ndarray, bins: int = BINS, most: int = 65535) -> np.ndarray:
    """Counts of words in a few bins; half the difference of two is never above their edit distance, not even
    with the difference of their lengths added, since an edit adds one word and takes away one at most.

    Counts end at ``most``, which makes no difference larger.
    """
    return np.minimum(np.bincount(words % bins, minlength=bins), most).astype(np.int32)


def labelled(values: np.ndarray) -> np.ndarray:
    """Values together with how often each occurred before, sorted: a multiset as a set."""
    values = np.sort(values.astype(np.int64))
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else values
    seen = np.arange(len(values)) - np.repeat(first, np.diff(np.append(first, len(values))))
    return np.sort(values * np.int64(0x9E3779B1) + seen)


@dataclass
class Words:
    """The words of a text, and what bounds edit distances: a histogram, its words and word pairs as sets.

    Each is made when it is first asked for, since cheaper ones decide on most pairs.
    """

    words: np.ndarray

    @classmethod
    def of(cls, packed) -> Words:
        return cls(np.frombuffer(packed, "<i4"))

    @cached_property
    def bins(self) -> np.ndarray:
        return histogram(self.words)

    @cached_property
    def singles(self) -> np.ndarray:
        return labelled(self.words)

    @cached_property
    def pairs(self) -> np.ndarray:
        wide = self.words.astype(np.int64)
        return labelled((wide[1:] << 31) ^ wide[:-1])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def similar(a: Words, b: Words, similarity: float = SIMILARITY) -> bool:
    """Whether the edit distance is small enough.

    An edit changes one word and at most two word pairs of either text, so texts with too few of them
    in common need no alignment.
    """
    n = max(len(a.words), len(b.words))
    limit = allowed(len(a.words), len(b.words), similarity)
    longer = abs(len(a.words) - len(b.words))
    if (longer > limit or np.abs(a.bins - b.bins).sum() + longer > 2 * limit
            or _common(a.singles, b.singles) < n - limit
            or _common(a.pairs, b.pairs) < n - 1 - 2 * limit):
        return False
    return banded_distance(a.words, b.words, limit) >= 0


def linked(a: str, b: str, similarity: float = SIMILARITY) -> Column:
    """Whether two columns of word values are similar enough."""

    @F.arrow_udf("boolean")
    def verified(left: pa.Array, right: pa.Array) -> pa.Array:
        out, last, held = [], None, None
        for x, y in zip(left, right):
            packed = x.as_buffer()
            if last is None or not last.equals(packed):  # pairs come ordered by their left side
                last, held = packed, Words.of(packed)
            out.append(similar(held, Words.of(y.as_buffer()), similarity))
        return pa.array(out, pa.bool_())

    return verified(a, b)


def signature(words: str | Column, keys: str | Column) -> Column:
    """Struct of the number of words, their bins, and the packed sketches.

    A text of few words has the bin of each word, a longer one packed counts.
    """

    @F.arrow_udf("struct<n:int,bins:binary,sketches:binary>")
    def made(packed: pa.Array, keys: pa.Array) -> pa.Array:
        texts = [np.frombuffer(x.as_buffer(), "<i4") for x in packed]
        first, values = keys.offsets.to_numpy()[:-1], keys.values.to_numpy()
        # texts of no words are in no bucket and have no sketches
        sketches = [values[at:at + SKETCHES + CLOSE_SKETCHES].astype("<i8").tobytes() for at in first]
        return pa.StructArray.from_arrays(
            [pa.array([len(t) for t in texts], pa.int32()), pa.array(list(map(_packed_bins, texts)), pa.binary()),
             pa.array(sketches, pa.binary())], names=["n", "bins", "sketches"])

    return made(words, keys)


def _packed_bins(words: np.ndarray) -> bytes:
    if 2 * len(words) < FINE_BINS:
        return (words % FINE_BINS).astype("<u2").tobytes()
    return histogram(words, FINE_BINS, 255).astype(np.uint8).tobytes()


def _histograms(packed: list[bytes], n: np.ndarray) -> np.ndarray:
    """Counts of ``signature``, a row for each text; all end at 255."""
    out = np.zeros((len(packed), FINE_BINS), np.int16)
    few = 2 * n < FINE_BINS
    at = np.frombuffer(b"".join(x for x, f in zip(packed, few) if f), "<u2")
    np.add.at(out.reshape(-1), np.repeat(np.flatnonzero(few) * FINE_BINS, n[few]) + at, 1)
    out[~few] = np.frombuffer(b"".join(x for x, f in zip(packed, few) if not f), np.uint8).reshape(-1, FINE_BINS)
    return np.minimum(out, 255, out=out)


def _block_candidates(rows: pa.Table, similarity: float) -> pa.Table:
    """Pairs of two blocks, or within one, that their signatures do not rule out and that are in two components.

    A pair is looked at in the bucket of the first sketch that both share, or if they share none in
    those of the words of short texts.
    """
    node, comp, n = (rows[x].to_numpy().astype(np.int64) for x in ("node", "component", "n"))
    order = np.lexsort((node, n))
    order = order[np.sort(np.unique(node[order], return_index=True)[1])]
    node, comp, n = node[order], comp[order], n[order]
    apart, upper = (rows[x].to_numpy()[order] for x in ("apart", "upper"))
    one = not upper.any()
    bucket = rows["key"][0].as_py()
    keys = np.frombuffer(b"".join(rows["sketches"].to_pylist()), "<i8").reshape(len(rows), -1)[order]
    packed = rows["bins"].to_pylist()
    bins = _histograms([packed[i] for i in order], n)
    folds = [bins if m == FINE_BINS else bins.reshape(len(node), -1, m).sum(1, dtype=np.int16) for m in FOLDS]
    # the longest text that one of n words may be within the limit of; rows are ordered by length
    reach = np.searchsorted(n, n + ((1 - similarity) * n / similarity + 1e-6).astype(np.int64) + 1, "right")
    left, right = [], []
    for i in range(len(node) - 1):
        near = np.arange(i + 1, reach[i])
        near = near[(apart[near] | apart[i]) & (comp[near] != comp[i]) & (one | (upper[near] != upper[i]))]
        if not len(near):
            continue
        most = 2 * ((1 - similarity) * n[near] + 1e-9).astype(np.int64) - (n[near] - n[i])
        ok = n[near] - n[i] <= most
        near, most = near[ok], most[ok]
        for counts in folds:
            ok = np.abs(counts[near] - counts[i]).sum(1) <= most
            near, most = near[ok], most[ok]
            if not len(near):
                break
        if len(near):
            shared = keys[near] == keys[i]
            near = near[np.where(shared.any(1), keys[i][shared.argmax(1)], bucket) == bucket]
            left.append(np.minimum(node[near], node[i]))
            right.append(np.maximum(node[near], node[i]))
    none = np.zeros(0, np.int64)
    return pa.table({"a": np.concatenate((none, *left)), "b": np.concatenate((none, *right))})


def memberships(sided: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``node, component, buckets``, a row for each document of ``key, node, n, component, apart`` that is to be compared.

    ``apart`` tells who is not in the component of its bucket's first document; who is has met it, so a
    bucket needs comparing if somebody is apart, and only pairs that hold one of these. A bucket of few
    members is one block. Others are cut by component, by bands of length, so that texts within the limit are in
    one band or two next to each other, and by hash; each two such blocks that may hold a pair are compared.
    """
    width = max(-math.log(similarity), 1e-6) * (1 + 1e-6)
    sided = sided.withColumn("band", F.floor(F.log("n") / width).cast("int"))
    sizes = sided.groupBy("key", "band", "apart").agg(F.count("*").alias("members")).withColumn(
        "cells", F.transform(F.sequence(F.lit(1), F.ceil(F.col("members") / BLOCK).cast("int")),
                             lambda i: F.struct("apart", "band", i.alias("part"))))
    buckets = sizes.groupBy("key").agg(
        F.sum("members").alias("members"), F.max("apart").alias("open"), F.flatten(F.collect_list("cells")).alias("cells"),
    ).where("open and members > 2").select("key", F.when(F.col("members") > BLOCK, F.col("cells")).alias("cells"))
    parts = F.size(F.filter("cells", lambda c: (c["apart"] == F.col("apart")) & (c["band"] == F.col("band"))))
    own = F.struct("apart", "band", (F.pmod(F.xxhash64("key", "node"), parts) + 1).cast("int").alias("part"))
    near = F.filter("cells", lambda c: (c["apart"] | F.col("apart")) & (F.abs(c["band"] - F.col("band")) <= 1))
    alone = F.struct(F.lit(True).alias("apart"), F.lit(0).alias("band"), F.lit(0).alias("part"))
    blocks = F.when(F.col("cells").isNull(), F.array(F.struct(alone.alias("low"), alone.alias("high"), F.lit(False).alias("upper"))))
    blocks = blocks.otherwise(F.transform(near, lambda c: F.struct(
        F.least(c, F.col("own")).alias("low"), F.greatest(c, F.col("own")).alias("high"), (F.col("own") > c).alias("upper"))))
    return sided.join(buckets, "key").withColumn("own", F.when(F.col("cells").isNotNull(), own)).groupBy("node").agg(
        F.min("component").alias("component"), F.collect_list(F.struct("key", "apart", blocks.alias("blocks"))).alias("buckets"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            similarity: float = SIMILARITY) -> DataFrame:
    """``id, h1, h2, class_id``: a row for each (id, text) of ``docs`` with both, and its class.

    The class id is the smallest id of the class. Equal texts are one class whatever their length,
    texts without words only by being equal. Rows that share an id are one document.
    """
    with shuffles_removed(docs.sparkSession):  # each step is stored
        sketched, firsts, final = _found(docs, id_col, text_col, similarity)
    found = firsts.join(final, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("class_id"))
    return sketched.select("id", "h1", "h2").join(found, ["h1", "h2"])


def _found(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored: ids with the hashes of their texts, the node of each text, and the component of each linked node."""
    spark = docs.sparkSession
    have = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull())
    hashes = (F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(5), F.col("text"), F.length("text")).alias("h2"))
    # 1. sketches of every text; of equal texts the one with the smallest id stands for all
    sketched = written(have.select("id", *hashes, candidate_keys("text").alias("s")).select("id", "h1", "h2", "s.*"),
                       "sketches")
    firsts = written(sketched.groupBy("h1", "h2").agg(F.min("id").alias("node")), "firsts")
    nodes = sketched.join(firsts.withColumnRenamed("node", "id"), ["h1", "h2", "id"], "left_semi")

    gone: list[str] = []  # folders that the result does not read
    # 2. buckets; each member of a bucket forms a pair with its first document
    members = nodes.select(F.explode("keys").alias("key"), F.col("id").alias("node"), "n")
    heads = written(
        members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("size"))
        .where("size > 1").select("key", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")), "heads", gone)
    stars = written(members.join(heads, "key").where("node <> head"), "stars", gone)
    short, long = F.least("n", "head_n"), F.greatest("n", "head_n")
    pairs = written(stars.where(long - short <= (1 - similarity) * long + 1e-9).select("head", "node").distinct(), "pairs", gone)

    # 3. alignment of the pairs; only texts in some bucket are needed again
    wanted = stars.select("node").union(stars.select(F.col("head").alias("node"))).distinct()
    named_keys = nodes.select(F.col("id").alias("node"), "keys").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    text_of = have.select(F.col("id").alias("node"), "text").join(named_keys, "node")
    words = written(text_of.select("node", "keys", word_values("text").alias("words")).dropDuplicates(["node"]), "words", gone)
    left = words.select(F.col("node").alias("head"), F.col("words").alias("head_words"))

    def links_of(pairs: DataFrame, label: str) -> DataFrame:
        checked = pairs.join(words.drop("keys"), "node").join(left, "head").select(
            F.col("head").alias("a"), F.col("node").alias("b"), linked("head_words", "words", similarity).alias("linked"))
        return written(checked.where("linked").select("a", "b"), label, gone)

    links = links_of(pairs, "links")
    label = written(components(links), "components", gone)

    # 4. what a bucket leaves apart from its first document
    named = (
        stars.select("key", "node", "n").union(heads.select("key", F.col("head").alias("node"), F.col("head_n").alias("n")))
        .join(label, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    )
    named = written(named, "named", gone)
    main = heads.join(label.withColumnRenamed("node", "head"), "head", "left").select(
        "key", F.coalesce("component", "head").alias("main"))
    sided = written(named.join(main, "key").select("key", "node", "n", "component", (F.col("component") != F.col("main")).alias("apart")),
                    "sided", gone)

    def compare(rows: pa.Table) -> pa.Table:
        return _block_candidates(rows, similarity)

    signed = words.join(memberships(sided, similarity), "node").select(
        "node", "component", "buckets", signature("words", "keys").alias("s"))
    blocked = signed.select("node", "component", "s.*", F.explode(F.flatten(F.transform("buckets", lambda of: F.transform(
        of["blocks"], lambda b: F.struct(of["key"].alias("key"), of["apart"].alias("apart"), b.alias("block")))))).alias("in"))
    candidates = written(
        blocked.select("node", "component", "n", "bins", "sketches", "in.key", "in.apart", "in.block.*")
        .groupBy("key", "low", "high").applyInArrow(compare, "a bigint, b bigint").distinct()
        .select(F.col("a").alias("head"), F.col("b").alias("node")), "candidates", gone)
    # 5. one candidate of each document first; then those that are still in two components
    some = candidates.groupBy("node").agg(F.min("head").alias("head")).select("head", "node")
    links = written(links.union(links_of(some, "more-links")), "linked", gone)
    label = written(components(links), "joined", gone)
    for side in ("head", "node"):
        candidates = candidates.join(label.select(F.col("node").alias(side), F.col("component").alias(f"{side}_c")), side, "left")
    apart = candidates.where(F.coalesce("head_c", "head") != F.coalesce("node_c", "node")).select("head", "node")
    final = written(components(links.union(links_of(apart, "last-links"))), "final")
    for path in gone:
        delete(spark, path)
    return sketched, firsts, final


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """``id_col, class_id, is_representative``, a row for each row of ``docs`` with an id and a text.

    ``class_id`` is the smallest id among documents connected by links; alone documents are a class of
    their own. Null ids and null texts are not compared and have no row. An empty table gives none.
    """
    return classes(docs, id_col, text_col, similarity).select(
        F.col("id").alias(id_col), "class_id", (F.col("id") == F.col("class_id")).alias("is_representative"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class left, its representative; rows with a null id or text stay."""
    dropped = (
        classes(docs, id_col, text_col, similarity).where("id <> class_id").select(F.col("id").alias(id_col)).distinct()
    )
    left = docs.join(dropped, id_col, "left_anti")
    compared = F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    # repeated rows of a representative: one stays
    return left.where(compared).dropDuplicates([id_col]).unionByName(left.where(~compared))
