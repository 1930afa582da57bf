"""Best-fit packing planned on the length histogram.

Documents become token pieces of at most ``capacity`` tokens. Only the histogram of piece lengths is
needed to plan: best fit is done on counts, whole runs of equal pieces at a time, so the plan has a
few thousand lines whatever the number of documents. Pieces then take the planned slots by joining
on (length, rank within the length).
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, insort
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinledger.operators.balance import written

CAPACITY = 1024
END_ID = 2
#: Pieces of one length that are ranked in one window partition, about.
RANK_ROWS = 500
#: Slots made from one row.
SLOT_ROWS = 4_096

# Characters whose classes do not depend on the version of Unicode that a library knows.
_USUAL = regex.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f\u0391-\u03a1\u03a3-\u03c9\u0410-\u044f"
                       "\u2010-\u2027\u2030-\u205e\u4e00-\u9fa5]*")
#: How byte-level BPE splits a text into words, and its letters for the bytes that are not printable (fixed values).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_letters() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(_PRINTABLE)]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers, those of ``tokenizers``.

    For a byte-level BPE vocabulary whose ids follow its merges, texts of usual characters are encoded
    from the same file by ``tiktoken``, which gives the same ids several times faster. All other
    texts, and all texts with any other vocabulary, go through ``tokenizers``.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.fast = self._same_by_ranks(vocabulary)

    @staticmethod
    def _same_by_ranks(vocabulary: str):
        import json

        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            whole = json.load(f)
        model, split = whole["model"], whole.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and not whole.get("normalizer") and split.get("type") == "ByteLevel"
                 and not split.get("add_prefix_space") and split.get("use_regex", True) and not model.get("ignore_merges"))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or ()]
        if not plain or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(merges)}
        return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.fast is not None and _USUAL.fullmatch(text):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str | None) -> Encoder:
    """The worker's encoder for a vocabulary file; by default the public byte-level BPE one."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


PIECES_TYPE = "array<struct<piece:int,start:bigint,length:bigint,ids:binary>>"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, but the first may be shorter."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)] if n else []
    return [(s, (starts[i + 1] if i + 1 < len(starts) else n) - s) for i, s in enumerate(starts)]


def pieces_of(text: str | Column, capacity: int = CAPACITY, end_id: int = END_ID,
              vocabulary: str | None = None) -> Column:
    """Array of token pieces of a text and the end token; a null text is an empty one."""
    end = np.array([end_id], "<u4").tobytes()

    @F.arrow_udf(PIECES_TYPE)
    def encoded(texts: pa.Array) -> pa.Array:
        made, offsets = encoder(vocabulary), [0]
        piece, start, length, ids = [], [], [], []
        for text in texts:
            whole = made.ids(text.as_py() or "") + end
            for i, (s, n) in enumerate(cut(len(whole) // 4, capacity)):
                piece.append(i)
                start.append(s)
                length.append(n)
                ids.append(whole[4 * s:4 * (s + n)])
            offsets.append(len(piece))
        rows = pa.StructArray.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
             pa.array(ids, pa.binary())], names=["piece", "start", "length", "ids"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return encoded(text)


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
             end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """``id_col, piece, start, length, ids``: a row for each piece, ``ids`` as packed 32-bit integers."""
    return docs.select(
        id_col, F.inline(pieces_of(text_col, capacity, end_id, vocabulary)),
    )


@dataclass(frozen=True)
class Slots:
    """``count`` slots for pieces of one length, of ranks ``rank`` and up, one in each sequence from
    ``sequence`` on, all at the same place."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best-fit decreasing over counts.

    The longest pieces come first. Each run of equal pieces goes to the open sequences with the least
    room that is enough, as many at once as there are, or else to new sequences. A run of sequences
    with equal room is one entry, so the work follows the number of distinct lengths.
    """
    slots: list[Slots] = []
    rooms: list[int] = []  # sorted, without repeats
    held: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, how many)
    made = 0

    def put_back(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in held:
                insort(rooms, room)
                held[room] = []
            held[room].append((first, n))

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = held[room].pop()
                if not held[room]:
                    del held[room], rooms[i]
            else:
                room, each = capacity, capacity // length
                first, n = made, -(-left // each)
                made += n
            each = room // length
            full = min(n, left // each)
            for k in range(each if full else 0):
                slots.append(Slots(length, rank, full, first, capacity - room + k * length))
                rank += full
            left -= full * each
            put_back(room - each * length, first, full)
            if full < n and left and left < each:
                for k in range(left):
                    slots.append(Slots(length, rank, 1, first + full, capacity - room + k * length))
                    rank += 1
                put_back(room - left * length, first + full, 1)
                left, full = 0, full + 1
            put_back(room, first + full, n - full)
    return slots


def slot_rows(spark: SparkSession, slots: list[Slots]) -> DataFrame:
    """``length, rank, sequence_id, offset``, a row for each slot, made on the executors."""
    lines = spark.createDataFrame(
        [(s.length, s.rank, s.count, s.sequence, s.offset) for s in slots],
        "length bigint, rank bigint, n bigint, sequence bigint, offset bigint")
    parts = lines.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {SLOT_ROWS}"))).alias("part"))
    spread = parts.repartition("length", "rank", "part")
    first = F.col("part") * SLOT_ROWS
    each = F.explode(F.sequence(first, F.least(first + SLOT_ROWS, F.col("n")) - 1)).alias("i")
    return spread.select("length", "rank", "sequence", "offset", each).select(
        "length", (F.col("rank") + F.col("i")).alias("rank"),
        (F.col("sequence") + F.col("i")).alias("sequence_id"), "offset")


def ranked(pieces: DataFrame, histogram: Mapping[int, int]) -> DataFrame:
    """``pieces`` with ``rank`` from 0 within each length.

    Ranks are counted inside hash blocks of a length and moved by the sizes of the blocks before,
    so no task sees all pieces of a common length. Order by all columns: only equal rows are tied.
    """
    if not histogram:
        return pieces.withColumn("rank", F.lit(0).cast("bigint"))
    # an entry for each length, so at most ``capacity``
    blocks = F.create_map(*[F.lit(x).cast("bigint") for n, c in histogram.items() for x in (n, -(-c // RANK_ROWS))])
    columns = sorted(pieces.columns)
    block = F.pmod(F.xxhash64(*columns), F.try_element_at(blocks, F.col("length")))
    blocked = pieces.withColumn("_block", block)
    sizes = blocked.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_block").orderBy(*columns)) - 1
    return (
        blocked.withColumn("_inside", inside).join(sizes, ["length", "_block"])
        .select(*pieces.columns, (F.col("_inside") + F.col("_before")).alias("rank"))
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; it needs a column ``length`` of 1 to ``capacity``.

    Every row gets one slot, repeated rows and rows with a null id too. Sequences are filled without
    gaps from 0. An empty table gives an empty result. The pieces are written once to the scratch
    folder, since the histogram and the join read them.
    """
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = slot_rows(spark, plan(histogram, capacity))
    return (
        ranked(pieces, histogram).join(slots, ["length", "rank"])
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """Packed pieces of ``docs`` with their ids: ``id_col, piece, start, length, ids, sequence_id, offset``."""
    return pack(tokenize(docs, id_col, text_col, capacity, end_id, vocabulary), capacity)
