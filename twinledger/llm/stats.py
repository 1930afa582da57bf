"""Rule statistics of whole texts, used by the quality rules and the quality classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from twinledger.llm.textvec import SPACE, Chunk, chunks, occurrence, windows

#: Counts made for every text, in this order.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars",
    "n_upper", "n_digits", "n_marks", "n_pipes", "n_exclaims", "n_same_words", "n_distinct_words",
    "n_capital_words", "n_long_words", "n_short_words", "n_symbol_words", "n_non_ascii",
    "longest_word", "n_stops",
)
STATS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

#: Ratios that a model sees. Each is near one value for prose, whatever its length.
FEATURES = (
    "log_words", "word_length", "symbols_per_word", "dup_line_share", "repeat_share",
    "upper_share", "digit_share", "mark_share", "pipes_per_word", "exclaims_per_word",
    "same_share", "distinct_share", "capital_share", "long_share", "short_share",
    "symbol_word_share", "words_per_line", "words_per_stop", "log_longest",
)


def _set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOL = _set("#*$%&|<>")
_MARK = _set("!\"'(),-./:;?@[\\]^_`{}~+=")
_DIGIT = _set("0123456789")
_UPPER = _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_STOP = _set(".!?")


def chunk_counts(c: Chunk) -> dict[str, np.ndarray]:
    """The counts of COUNTS for each document of a chunk."""
    data, docs = c.data, c.docs
    head = (data & 0xC0) != 0x80  # first byte of each code point
    space = SPACE[data]
    s, e = c.words()
    owner = c.owner(s)
    number = lambda where: np.bincount(where, minlength=docs).astype(np.int64)
    out = {
        "n_words": number(owner),
        "n_chars": c.per_doc(head),
        "word_chars": c.per_doc(head & ~space),
        "n_symbols": c.per_doc(_SYMBOL[data]),
        "n_digits": c.per_doc(_DIGIT[data]),
        "n_marks": c.per_doc(_MARK[data]),
        "n_pipes": c.per_doc(data == ord("|")),
        "n_exclaims": c.per_doc(data == ord("!")),
        "n_stops": c.per_doc(_STOP[data]),
        "n_non_ascii": c.per_doc(data >= 0xC0),
    }
    # capitals: A-Z, and the two-byte Latin-1 ones (lead byte C3, second byte 80-9E but 97)
    nxt = np.concatenate((data[1:], [0])).astype(np.uint8) if len(data) else data
    upper = _UPPER[data] | ((data == 0xC3) & (nxt >= 0x80) & (nxt <= 0x9E) & (nxt != 0x97))
    out["n_upper"] = c.per_doc(upper)

    ls, le = c.lines()
    heads = np.concatenate(([0], np.cumsum(~space)))
    full = heads[le] > heads[ls]
    ls, le = ls[full], le[full]
    line_owner = c.owner(ls)
    seen, _ = occurrence(c.fingerprints(ls, le), line_owner)
    out["n_lines"] = number(line_owner)
    out["n_dup_lines"] = number(line_owner[seen > 0])

    word = c.fingerprints(s, e)
    triple, at = windows(word, owner, 3)
    _, times = occurrence(triple, owner[at])
    covered = np.zeros(len(s), bool)
    twice = at[times > 1]
    for j in range(3):
        covered[twice + j] = True
    out["n_repeat_words"] = number(owner[covered])
    same = np.flatnonzero((word[1:] == word[:-1]) & (owner[1:] == owner[:-1])) if len(s) else s
    out["n_same_words"] = number(owner[same])
    seen, _ = occurrence(word, owner)
    out["n_distinct_words"] = number(owner[seen == 0])

    points = np.concatenate(([0], np.cumsum(head)))
    length = points[e] - points[s]
    out["n_long_words"] = number(owner[length > 20])
    out["n_short_words"] = number(owner[length < 3])
    out["longest_word"] = np.zeros(docs, np.int64)
    np.maximum.at(out["longest_word"], owner, length)
    capitals = np.concatenate(([0], np.cumsum(upper)))
    out["n_capital_words"] = number(owner[(capitals[e] - capitals[s]) * 2 > length])
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    out["n_symbol_words"] = number(owner[symbols[e] > symbols[s]])
    return out


def count_table(texts: pa.Array) -> dict[str, np.ndarray]:
    parts = [chunk_counts(c) for c in chunks(texts)]
    if not parts:
        return {name: np.zeros(0, np.int64) for name in COUNTS}
    return {name: np.concatenate([p[name] for p in parts]) for name in COUNTS}


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Matrix of FEATURES, a row for each text; an empty text gets finite values too."""
    n = {k: np.asarray(v, np.float64) for k, v in counts.items()}
    words = np.maximum(n["n_words"], 1)
    chars = np.maximum(n["word_chars"], 1)
    lines = np.maximum(n["n_lines"], 1)
    return np.column_stack([
        np.log1p(n["n_words"]),
        n["word_chars"] / words,
        n["n_symbols"] / words,
        n["n_dup_lines"] / lines,
        n["n_repeat_words"] / words,
        n["n_upper"] / chars,
        n["n_digits"] / chars,
        n["n_marks"] / chars,
        n["n_pipes"] / words,
        n["n_exclaims"] / words,
        n["n_same_words"] / words,
        n["n_distinct_words"] / words,
        n["n_capital_words"] / words,
        n["n_long_words"] / words,
        n["n_short_words"] / words,
        n["n_symbol_words"] / words,
        np.log1p(n["n_words"] / lines),
        np.log1p(n["n_words"] / np.maximum(n["n_stops"], 1)),
        np.log1p(n["longest_word"]),
    ])


def rule_statistics(text: str | Column) -> Column:
    """Struct of COUNTS for a text column."""

    @F.arrow_udf(STATS_TYPE)
    def counted(texts: pa.Array) -> pa.Array:
        table = count_table(texts)
        return pa.StructArray.from_arrays([pa.array(table[c], pa.int64()) for c in COUNTS], names=list(COUNTS))

    return counted(text)
