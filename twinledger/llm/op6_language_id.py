"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram is the product of its letters' vectors, each
permuted by its position; a text is the sum of its n-grams, a language the sum of its texts.
A text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.sampling import bounded_sample, fold

DIMENSIONS = 1024
N = 3
#: Learning rows, at most.
FIT_ROWS = 20_000
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Vectors of n-grams that a worker keeps at a time.
CACHED = 1 << 16
#: Texts bundled together, and the most n-grams expanded into vectors at a time.
TOGETHER = 64
BLOCK = 1 << 12

_SPACE = 32
_folded: dict[int, int] = {}


def _letter(point: int) -> int:
    """Lower-case letter of a code point; anything but a letter is a blank."""
    got = _folded.get(point)
    if got is None:
        c = chr(point)
        low = c.lower()
        got = ord(low[0]) if unicodedata.category(c)[0] == "L" else _SPACE
        if len(_folded) > 1 << 17:
            _folded.clear()
        _folded[point] = got
    return got


_LATIN = np.array([_letter(i) for i in range(0x250)], np.int64)


def letters(text: str) -> np.ndarray:
    """Code points of the folded text with single blanks around and between runs of letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = _LATIN[np.minimum(points, len(_LATIN) - 1)]
    rare = np.flatnonzero(points >= len(_LATIN))
    if len(rare):
        kinds, where = np.unique(points[rare], return_inverse=True)
        out[rare] = np.array([_letter(int(k)) for k in kinds])[where]
    out = np.concatenate(([_SPACE], out, [_SPACE]))
    return out[np.concatenate(([True], (out[1:] != _SPACE) | (out[:-1] != _SPACE)))]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, packed into one number each, and how often they occur."""
    got = letters(text) if text else np.zeros(0, np.int64)
    if len(got) < N:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.zeros(len(got) - N + 1, np.int64)
    for j in range(N):
        codes = (codes << 21) | got[j:len(got) - N + 1 + j]
    return np.unique(codes, return_counts=True)


class Vectors:
    """Vectors of n-grams, made when first needed."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 3):
        self.dimensions, self.seed = dimensions, seed
        self.clear()

    def clear(self) -> None:
        self.row: dict[int, int] = {}
        self.letter: dict[int, np.ndarray] = {}
        self.matrix = np.zeros((1024, self.dimensions), np.int8)

    def _letter_vector(self, point: int) -> np.ndarray:
        if point not in self.letter:
            bits = np.random.default_rng((self.seed, point)).integers(0, 2, self.dimensions)
            self.letter[point] = (2 * bits - 1).astype(np.int8)
        return self.letter[point]

    def _make(self, code: int) -> np.ndarray:
        out = np.ones(self.dimensions, np.int8)
        for j in range(N):
            point = (code >> (21 * (N - 1 - j))) & ((1 << 21) - 1)
            out = out * np.roll(self._letter_vector(point), N - 1 - j)
        return out

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Where the vectors of these n-grams stand in ``matrix``."""
        if len(self.row) + len(codes) > CACHED:
            self.clear()
        out = np.empty(len(codes), np.int64)
        for i, code in enumerate(codes.tolist()):
            at = self.row.get(code)
            if at is None:
                at = self.row[code] = len(self.row)
                if at == len(self.matrix):
                    self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
                self.matrix[at] = self._make(code)
            out[i] = at
        return out

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """Sum of the n-gram vectors of each text, at length 1; zeros for a text without letters."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        codes, counts = zip(*map(ngrams, texts)) if texts else ((), ())
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
        if not len(owner):
            return out
        kinds, column = np.unique(np.concatenate(codes), return_inverse=True)
        counts = np.concatenate(counts).astype(np.float32)
        for lo in range(0, len(kinds), BLOCK):
            here = (column >= lo) & (column < lo + BLOCK)
            table = np.zeros((len(texts), min(BLOCK, len(kinds) - lo)), np.float32)
            table[owner[here], column[here] - lo] = counts[here]
            rows = self.rows(kinds[lo:lo + BLOCK])  # may enlarge the matrix
            out += table @ self.matrix[rows].astype(np.float32)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


_vectors: dict[tuple[int, int], Vectors] = {}


def vectors(dimensions: int, seed: int) -> Vectors:
    return _vectors.setdefault((dimensions, seed), Vectors(dimensions, seed))


@dataclass
class Profiles:
    """One prototype a language, less what all languages share, at length 1."""

    langs: list[str]
    prototypes: np.ndarray
    shared: np.ndarray
    seed: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        made = vectors(len(self.shared), self.seed)
        langs, scores = [], []
        for lo in range(0, len(texts), TOGETHER):
            v = made.bundle(texts[lo:lo + TOGETHER])
            known = v.any(axis=1) if self.langs else np.zeros(len(v), bool)
            v = v - self.shared
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            cosines = v @ self.prototypes.T if self.langs else np.zeros((len(v), 1))
            best = cosines.argmax(1)
            langs += [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            scores += np.where(known, cosines.max(1).clip(0, 1), 0.0).tolist()
        return langs, scores


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = FIT_ROWS, dimensions: int = DIMENSIONS, seed: int = 3) -> Profiles:
    """Prototypes from at most ``rows`` documents outside the held-out fold with a language and a text.

    The texts of a language are bundled inside the tasks; only one sum a language reaches the driver.
    """
    learn = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                       & (fold(id_col, FOLDS) != HELD_OUT))
    ids = bounded_sample(learn.select(id_col), id_col, rows).distinct()
    # at most ``rows`` ids; some repeat if rows of the table do
    texts = learn.select(id_col, lang_col, text_col).join(F.broadcast(ids), id_col, "left_semi")

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, sums = vectors(dimensions, seed), {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(texts), TOGETHER):
                for lang, v in zip(langs[lo:lo + TOGETHER], made.bundle(texts[lo:lo + TOGETHER])):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            names=["lang", "part"])

    parts = texts.select(lang_col, text_col).mapInArrow(bundled, "lang string, part array<double>")
    total = (
        parts.select("lang", F.posexplode("part").alias("i", "v"))
        .groupBy("lang", "i").agg(F.sum("v").alias("v"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "v")))["v"].alias("v"))
        .orderBy("lang").collect()
    )
    if not total:
        return Profiles([], np.zeros((0, dimensions)), np.zeros(dimensions), seed)
    unit = np.array([np.asarray(r["v"]) / max(float(np.linalg.norm(r["v"])), 1e-12) for r in total])
    shared = unit.mean(0) if len(unit) > 1 else np.zeros(dimensions)
    own = unit - shared
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
    return Profiles([r["lang"] for r in total], own, shared, seed)


def predict(text: str | Column, profiles: Profiles) -> Column:
    """Struct ``lang, score`` for whole texts."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        langs, scores = profiles.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                          names=["lang", "score"])

    return predicted(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, held_out, lang_pred, score``, a row for each row of ``docs``.

    A null text or one without letters is ``und`` with score 0, and so is every text if no row can
    be learnt from. Ties go to the language that sorts first. No shuffle but for the prototypes.
    """
    profiles = fit(docs, id_col, text_col, lang_col)
    return docs.select(
        id_col, (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"), predict(text_col, profiles).alias("_p"),
    ).select(id_col, "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))
