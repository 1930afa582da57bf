"""Benchmark decontamination by pigeonhole edit matching.

A test item of n words may occur with up to ``error_rate * n`` word edits. It is split into one piece
more than it has errors to spend, so any such occurrence holds at least one piece unchanged. Exact
piece hits are looked up by fingerprint, and the text around a hit is verified with Myers'
bit-parallel distance over words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.textvec import Chunk, chunks, windows

ERROR_RATE = 0.2
#: Shorter items have to occur unchanged.
MIN_WORDS = 8
#: Words of a piece that are looked up, at most.
PIECE_WORDS = 6
#: Items in one pass over the documents; their pieces are sent to every executor.
ITEMS_TOGETHER = 20_000

HITS_TYPE = "array<struct<item:bigint,distance:int,first_word:int,last_word:int>>"

_OTHER_MARKS = re.compile("[\u0080-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2000-\u206f\u3000-\u303f\uff01-\uff0f]")
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_WORD[128:] = True


def normalised(text: str | None) -> str:
    """Lower case, with punctuation beyond ASCII as blanks."""
    text = (text or "").lower()
    return text if text.isascii() else _OTHER_MARKS.sub(" ", text)


def chunk_words(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and owners of the runs of letters and digits of a chunk of normalised texts."""
    s, e = c.runs(_WORD[c.data])
    return c.fingerprints(s, e), c.owner(s)


def word_lists(texts: list[str | None]) -> list[np.ndarray]:
    out = []
    for c in chunks(pa.array([normalised(t) for t in texts], pa.large_string())):
        word, owner = chunk_words(c)
        cuts = np.searchsorted(owner, np.arange(c.docs + 1))
        out += [word[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


def budget(n: int, rate: float = ERROR_RATE) -> int:
    return int(rate * n + 1e-9) if n >= MIN_WORDS else 0


@dataclass
class Pieces:
    """Looked-up pieces of some items: for each length in words, sorted fingerprints with the item and
    the place of the piece in it."""

    items: dict[int, np.ndarray]
    rate: float
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    #: Item ids by the numbers that items have here.
    ids: tuple[int, ...] = ()

    @classmethod
    def of(cls, items: list[tuple[int, str | None]], rate: float = ERROR_RATE) -> Pieces:
        words = {i: w for (i, _), w in zip(items, word_lists([t for _, t in items])) if len(w)}
        found: dict[int, list[tuple[int, int, int]]] = {}
        for item, w in words.items():
            parts = budget(len(w), rate) + 1
            for k in range(parts):
                at, end = len(w) * k // parts, len(w) * (k + 1) // parts
                size = min(end - at, PIECE_WORDS)  # the head of an unchanged piece is unchanged
                value, _ = windows(w[at:at + size], np.zeros(size, np.int64), size)
                found.setdefault(size, []).append((int(value[0]), item, at))
        tables = {}
        for size, rows in found.items():
            value = np.array([r[0] for r in rows], np.uint64)
            order = np.argsort(value, kind="stable")
            tables[size] = (value[order], np.array([r[1] for r in rows], np.int64)[order],
                            np.array([r[2] for r in rows], np.int64)[order])
        return cls(words, rate, tables)

    def hits(self, word: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, item, word where the item would begin) of exact piece hits."""
        for size, (value, item, at) in self.tables.items():
            gram, where = windows(word, owner, size)
            low = np.searchsorted(value, gram, "left")
            for g in np.flatnonzero((low < len(value)) & (value[np.minimum(low, len(value) - 1)] == gram)):
                j = int(low[g])
                while j < len(value) and value[j] == gram[g]:
                    yield int(owner[where[g]]), int(item[j]), int(where[g] - at[j])
                    j += 1


def myers(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and the first end (exclusive) of one.

    A column of the alignment matrix is held as two bit vectors of vertical steps up and down.
    """
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        masks[w] = masks.get(w, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text.tolist()):
        equal = masks.get(w, 0)
        same = equal | down
        zero = ((((same & up) + up) ^ up) | same) & full  # no step along the diagonal
        right, left = (down | ~(zero | up)) & full, up & zero
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        # a match may begin anywhere, so the top row has no steps
        right, left = (right << 1) & full, (left << 1) & full
        up, down = (left | ~(zero | right)) & full, right & zero
        if score < best:
            best, end = score, j + 1
    return best, end


def best_matches(pieces: Pieces, word: np.ndarray, owner: np.ndarray, docs: int) -> list[list[tuple]]:
    """Verified items of each document: (item, distance, first word, last word), the best place of each."""
    cuts = np.searchsorted(owner, np.arange(docs + 1))
    found: list[dict[int, tuple]] = [{} for _ in range(docs)]
    looked: set[tuple[int, int]] = set()
    for doc, item, start in pieces.hits(word, owner):
        if (item, start) in looked:
            continue
        looked.add((item, start))
        pattern = pieces.items[item]
        spare = budget(len(pattern), pieces.rate)
        lo = max(int(cuts[doc]), start - spare)
        hi = min(int(cuts[doc + 1]), start + len(pattern) + spare)
        distance, end = myers(pattern, word[lo:hi])
        if distance > spare:
            continue
        # the same backwards from the end gives the beginning
        _, back = myers(pattern[::-1], word[lo:lo + end][::-1])
        first, last = lo + end - back - int(cuts[doc]), lo + end - 1 - int(cuts[doc])
        old = found[doc].get(item)
        if old is None or (distance, first) < (old[1], old[2]):
            found[doc][item] = (item, distance, first, last)
    return [sorted(f.values()) for f in found]


def matches(text: str | Column, pieces: Pieces) -> Column:
    """Array of the items that occur in a text."""
    shared = pieces

    @F.arrow_udf(HITS_TYPE)
    def found(texts: pa.Array) -> pa.Array:
        plain = pa.array([normalised(t.as_py()) for t in texts], pa.large_string())
        rows: list[list[tuple]] = []
        for c in chunks(plain):
            rows += best_matches(shared, *chunk_words(c), c.docs)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        flat = [x for r in rows for x in r]
        kinds = (("item", pa.int64()), ("distance", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32()))
        values = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], k) for i, (_, k) in enumerate(kinds)],
                                            names=[n for n, _ in kinds])
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    return found(text)


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                together: int = ITEMS_TOGETHER, rate: float = ERROR_RATE) -> Iterator[Pieces]:
    """All items with an id, in blocks of at most about ``together``, so a large benchmark is matched in
    several passes. Every pass sees all documents. Items without words match nothing. Rows that share an
    id but not the text are items of their own, equal rows one."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(text_col).alias("text")).where(
        F.col("item").isNotNull() & F.col("text").isNotNull())
    blocks = max(1, -(-items.count() // together))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = sorted({(r["item"], r["text"]) for r in part.collect()})
        pieces = Pieces.of([(i, text) for i, (_, text) in enumerate(rows)], rate)
        yield replace(pieces, ids=tuple(item for item, _ in rows))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE,
                 together: int = ITEMS_TOGETHER) -> DataFrame:
    """``id_col, item_col, distance, n_words, first_word, last_word``: every item in every document.

    The place is that of the best occurrence, the first of equal ones, in words of the document from 0.
    Null and empty texts hold no item. Items with equal texts are all reported, repeated documents too;
    of rows that share an item id each different text is looked for and has its own row. No shuffle.
    """
    spark, parts = docs.sparkSession, []
    for pieces in item_blocks(benchmark, item_col, item_text, together, rate):
        sizes = spark.createDataFrame([(i, pieces.ids[i], len(w)) for i, w in pieces.items.items()], "item bigint, item_id bigint, n_words int")
        hits = docs.select(F.col(id_col).alias("_id"), F.inline(matches(text_col, pieces)))
        parts.append(hits.join(F.broadcast(sizes), "item").select(  # at most ``together`` rows
            F.col("_id").alias(id_col), F.col("item_id").alias(item_col), "distance", "n_words", "first_word", "last_word"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", rate: float = ERROR_RATE, together: int = ITEMS_TOGETHER) -> DataFrame:
    """Rows of ``docs`` that hold no item, with all their columns."""
    for pieces in item_blocks(benchmark, item_col, item_text, together, rate):
        docs = docs.where(F.size(matches(text_col, pieces)) == 0)
    return docs
