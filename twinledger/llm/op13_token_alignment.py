"""Token streams of two tokenizers over the same texts, aligned by byte ranges.

A is a byte-level BPE vocabulary on a space and the text, B a sentencepiece model on the text, which puts
the space in front itself. Per batch, ``pandas.merge_asof`` keyed by document finds for each token start
the token of the other side that covers it; both directions together are all overlapping pairs.
Pairs that also end together close a group, the smallest stretch that both sides cut alike.

A pair of ids is counted once for each document of the corpus that holds it linked in a group. Pairs
that are common are few, so their counts are broadcast up to a bound; all others are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.op4_packing import _byte_letters, encoder
from twinledger.operators.balance import small_enough, written

#: Text that is aligned at once; a longer one is a batch of its own.
BATCH_CHARS = 1 << 18
#: Id pairs whose counts are broadcast.
BROADCAST_PAIRS = 1_000_000
#: An id pair as one number: A id * 2^20 + B id.
B_BITS = 20

SPACE_MARK = "▁"
ALIGNED_TYPE = ("struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,"
                "pairs:array<bigint>,times:array<bigint>>")


class Sides:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, a_vocabulary: str | None, b_model: str | None):
        import public_tokenizers
        import sentencepiece

        a_vocabulary = a_vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        self.a = encoder(a_vocabulary)
        with open(a_vocabulary, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters = _byte_letters()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_model or public_tokenizers.path("piece_bpe_32k.model"))
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_length = np.array([len(t) for t in self.a_bytes])
        self.b_length = np.array([len(t) for t in self.b_bytes])

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none if the text is null or empty or a side does not spell it byte by byte."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        spelled = " " + text
        a = np.frombuffer(self.a.ids(spelled), "<u4").astype(np.int64)
        b = self.b.encode(text, num_threads=1)
        whole = spelled.encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole or not self._spells(a, whole):
            return none
        return a, np.array(b, np.int64)

    def _spells(self, a: np.ndarray, whole: bytes) -> bool:
        # each byte has a token and merges only join bytes, so equal lengths mean equal bytes; a
        # vocabulary that changes or drops bytes is looked at in full
        if self.a.fast is not None:
            return int(self.a_length[a].sum()) == len(whole)
        return b"".join(map(self.a_bytes.__getitem__, a.tolist())) == whole


_sides: dict[tuple, Sides] = {}


def sides(a_vocabulary: str | None = None, b_model: str | None = None) -> Sides:
    """The worker's tokenizers."""
    key = a_vocabulary, b_model
    if key not in _sides:
        _sides[key] = Sides(*key)
    return _sides[key]


def _ranges(ids: Sequence[np.ndarray], length: np.ndarray, base: np.ndarray, side: str) -> pd.DataFrame:
    """A row a token: document, id, and its byte range, moved by the document's base."""
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    token = np.concatenate(ids) if len(ids) else np.zeros(0, np.int64)
    size = length[token]
    end = np.cumsum(size)
    sizes = np.bincount(doc, size, len(ids)).astype(np.int64)
    end += (base - np.concatenate(([0], np.cumsum(sizes)))[:-1])[doc]
    return pd.DataFrame({"doc": doc, "at": end - size, f"{side}_end": end, f"{side}_id": token, side: np.arange(len(token))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of tokens whose byte ranges overlap: ``doc, a, b, a_end, b_end``.

    Each token start looks backward for the other side's token that covers it.
    """
    doc, left, right = _overlapping(a, b)
    return pd.DataFrame({"doc": doc, "a": left, "b": right, "a_end": a["a_end"].to_numpy()[left], "b_end": b["b_end"].to_numpy()[right]})


def _overlapping(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, A token and B token of each overlap."""
    left, right = a[["doc", "at", "a"]], b[["doc", "at", "b"]]
    from_a = pd.merge_asof(left, right, on="at", by="doc")
    from_b = pd.merge_asof(right, left, on="at", by="doc")
    found = from_b["a"].to_numpy()
    # a pair of tokens that start together was found from both sides
    new = a["at"].to_numpy()[found] < from_b["at"].to_numpy() if len(b) else np.zeros(0, bool)
    return tuple(np.concatenate((x[c].to_numpy(), y)) for x, c, y in (
        (from_a, "doc", from_b["doc"].to_numpy()[new]), (from_a, "a", found[new]), (from_a, "b", from_b["b"].to_numpy()[new])))


def groups_of(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each A token, of each B token, and document of each group."""
    _, left, right = _overlapping(a, b)
    closing = a["a_end"].to_numpy()[left] == b["b_end"].to_numpy()[right]
    groups = []
    for side, tokens in ((a, left), (b, right)):
        last = np.zeros(len(side), bool)
        last[tokens[closing]] = True
        # a token is in the group after those that were closed before it
        groups.append((np.cumsum(last) - last, last))
    (group_a, last_a), (group_b, _) = groups
    return group_a, group_b, a["doc"].to_numpy()[last_a]


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group and how often they occur in it."""
    key, times = np.unique(group << B_BITS | ids, return_counts=True)
    return key >> B_BITS, key & (1 << B_BITS) - 1, times


def _linked(group_a, ids_a, group_b, ids_b, doc_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked id pairs of each document: document, pair, number of links."""
    n = len(doc_of)
    size_a, size_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    # one token on either side is one link; where both sides have more, ids may repeat and are counted first
    one = (size_a == 1) | (size_b == 1)
    in_a, in_b = one[group_a], one[group_b]
    ga, ia, na = _counted(group_a[~in_a], ids_a[~in_a])
    gb, ib, nb = _counted(group_b[~in_b], ids_b[~in_b])
    first, many = np.searchsorted(gb, ga), np.searchsorted(gb, ga, "right")
    many = many - first
    left = np.repeat(np.arange(len(ga)), many)
    right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + first[left]
    # a group with one token on a side has as many links as tokens on the other
    links = np.maximum(size_a, size_b)[one]
    only_a, only_b = (np.repeat(ids, np.where(size == 1, other, 1)[group]) for ids, size, other, group in (
        (ids_a[in_a], size_a, size_b, group_a[in_a]), (ids_b[in_b], size_b, size_a, group_b[in_b])))
    doc = np.concatenate((doc_of[ga[left]], np.repeat(doc_of[one], links)))
    pair = np.concatenate((ia[left] << B_BITS | ib[right], only_a << B_BITS | only_b))
    times = np.concatenate((na[left] * nb[right], np.ones(len(only_a), np.int64)))
    if not len(doc):
        return doc, pair, times
    # documents of a batch and pairs are numbers that fit into one
    key = doc << 2 * B_BITS | pair
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[new] >> 2 * B_BITS, key[new] & (1 << 2 * B_BITS) - 1, np.add.reduceat(times[order], new)


def _written_groups(docs: int, a_doc, group_a, ids_a, b_doc, group_b, ids_b) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document."""
    n = int(max(group_a.max(initial=-1), group_b.max(initial=-1))) + 1
    # tokens of both sides are in the order of their groups: one goes behind those of the other side before it
    before_b = np.cumsum(np.bincount(group_b, minlength=n)) - np.bincount(group_b, minlength=n)
    up_to_a = np.cumsum(np.bincount(group_a, minlength=n))
    at_a, at_b = np.arange(len(ids_a)) + before_b[group_a], np.arange(len(ids_b)) + up_to_a[group_b]
    place = np.zeros(len(ids_a) + len(ids_b), np.int64)
    for at, group, ids, end in ((at_a, group_a, ids_a, 1), (at_b, group_b, ids_b, 2)):
        mark = np.append(np.where(group[1:] == group[:-1], 0, end), end)[:len(ids)]
        place[at] = 3 * ids + mark
    marked = _marked(int(place.max(initial=0)) // 3 + 1)
    words = list(map(marked.__getitem__, place.tolist()))
    sizes = np.bincount(a_doc, minlength=docs) + np.bincount(b_doc, minlength=docs)
    bounds = np.concatenate(([0], np.cumsum(sizes))).tolist()
    return ["".join(words[lo:hi])[:-1] for lo, hi in zip(bounds[:-1], bounds[1:])]


_texts: list[str] = []


def _marked(ids: int) -> list[str]:
    """Every id in decimal with each of the three marks behind it."""
    if len(_texts) < 3 * ids:
        _texts[:] = [f"{i}{mark}" for i in range(max(ids, 1 << 16)) for mark in ",|;"]
    return _texts


def align(texts: Sequence[str | None], made: Sides) -> dict:
    """The columns of ``ALIGNED_TYPE`` for a batch of texts."""
    a_ids, b_ids = zip(*map(made.tokens, texts)) if len(texts) else ((), ())
    n = len(texts)
    lengths = np.array([int(made.a_length[x].sum()) for x in a_ids], np.int64)
    base = np.concatenate(([0], np.cumsum(lengths)))[:-1] if n else np.zeros(0, np.int64)
    a, b = _ranges(a_ids, made.a_length, base, "a"), _ranges(b_ids, made.b_length, base, "b")
    group_a, group_b, doc_of = groups_of(a, b)
    ids_a, ids_b = a["a_id"].to_numpy(), b["b_id"].to_numpy()
    doc, pair, times = _linked(group_a, ids_a, group_b, ids_b, doc_of)
    shown = _written_groups(n, a["doc"].to_numpy(), group_a, ids_a, b["doc"].to_numpy(), group_b, ids_b)
    return {
        "n_a": np.array([len(x) for x in a_ids], np.int64), "n_b": np.array([len(x) for x in b_ids], np.int64),
        "n_groups": np.bincount(doc_of, minlength=n), "n_links": np.bincount(doc, times, n).astype(np.int64),
        "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown],
        "groups": shown, "at": np.searchsorted(doc, np.arange(n + 1)), "pairs": pair, "times": times,
    }


def _batches(texts: list[str | None]) -> Iterator[list[str | None]]:
    lo, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > BATCH_CHARS:
            yield texts[lo:i + 1]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield texts[lo:]


def alignment(text: str | Column, a_vocabulary: str | None = None, b_model: str | None = None) -> Column:
    """Struct of counts, the hash of the groups, and the distinct linked id pairs with their numbers of links."""

    @F.arrow_udf(ALIGNED_TYPE)
    def aligned(column: pa.Array) -> pa.Array:
        made, parts = sides(a_vocabulary, b_model), []
        names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
        for texts in _batches(column.to_pylist()):
            x = align(texts, made)
            at = pa.array(x["at"].astype(np.int32))
            arrays = [pa.array(x[c]) for c in names[:4]] + [pa.array(x["groups_sha256"], pa.string())]
            arrays += [pa.ListArray.from_arrays(at, pa.array(x[c].astype(np.int64))) for c in names[5:]]
            parts.append(pa.StructArray.from_arrays(arrays, names=names))
        if not parts:
            return pa.array([], pa.struct([(c, pa.int64()) for c in names[:4]] + [("groups_sha256", pa.string())]
                                          + [(c, pa.list_(pa.int64())) for c in names[5:]]))
        return pa.concat_arrays(parts)

    return aligned(text)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str | None = None,
           b_model: str | None = None) -> DataFrame:
    """``id_col, groups``: the aligned groups of each text, written as ``a1,a2|b1;a3|b2,b3``."""

    @F.arrow_udf("string")
    def shown(column: pa.Array) -> pa.Array:
        made = sides(a_vocabulary, b_model)
        return pa.array([s for texts in _batches(column.to_pylist()) for s in align(texts, made)["groups"]], pa.string())

    return docs.select(id_col, shown(text_col).alias("groups"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n_docs, best``: in how many documents an id pair is linked, and whether no other pair of its
    A id is in more. Counts are combined before the shuffle."""
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs")),
                     "pair-counts")
    a_id = F.shiftright("pair", B_BITS)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("n_docs").alias("most"))
    return counts.withColumn("a_id", a_id).join(most, "a_id").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _common_from(counts: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` pairs are in so many documents; 0 for all pairs."""
    if small_enough(counts, limit):
        return 0
    sizes = counts.groupBy(F.floor(F.log2("n_docs")).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()
    total, least = 0, 62  # counts of 2^62 do not occur
    for r in sorted(sizes, key=lambda r: -r["k"]):
        total += r["n"]
        if total > limit:
            break
        least = r["k"]
    return 1 << least


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str | None = None,
                    b_model: str | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, a row for each row of ``docs``.

    A null or empty text, or one that a side does not spell byte by byte, has zeros and ''. Rows with
    equal or null ids count one by one; other columns do not matter.
    """
    row = docs.select(F.col(id_col).alias("_id"), alignment(text_col, a_vocabulary, b_model).alias("_x"))
    aligned = written(row.select("_id", F.monotonically_increasing_id().alias("_row"), "_x.*"), "aligned")
    counts = written(pair_counts(aligned), "scored-pairs")
    least = _common_from(counts, broadcast_pairs)
    linked = aligned.select("_row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    common = F.broadcast(counts.where(F.col("n_docs") >= least))
    scored = linked.join(common, "pair")
    if least:
        rare = linked.join(common.select("pair"), "pair", "left_anti")
        scored = scored.unionByName(rare.join(counts.where(F.col("n_docs") < least), "pair"))
    sums = scored.groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return aligned.join(sums, "_row", "left").select(
        F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
