"""Secret scan: patterns propose candidates, a random forest removes false positives.

The forest sees the candidate's length, character transitions and dictionary coverage, the path it
stands in and the words beside it. It is trained from labelled findings: rows (before, candidate,
after, label), by default the generated ones of ``labelled_findings``.
"""

from __future__ import annotations

import base64
import math
import random
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled findings that the forest is trained on, at most.
FIT_ROWS = 20_000
CUT = 0.5
#: Characters of the text on either side that features may look at.
CONTEXT = 48

#: Names that a secret is assigned to (fixed values).
KEY_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key",
             "auth", "credential", "private_key", "passphrase", "bearer", "client_secret")
#: Words that stand beside things that only look like secrets (fixed values).
PLAIN_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "guid", "id", "isbn",
               "version", "order", "phone", "tel", "fax", "card", "build", "revision", "ref", "issue", "invoice",
               "example", "sample", "placeholder", "etag", "blob", "serial", "tracking")
#: Beginnings of issued keys (fixed values).
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "rk_live_",
            "AIza", "SG.", "eyJ", "npm_", "hf_", "pypi-", "-----BEGIN")
#: Common words and word parts of identifiers and placeholders (fixed values).
DICTIONARY = ("password", "secret", "example", "change", "changeme", "your", "here", "test", "value", "key", "token",
              "name", "user", "admin", "default", "config", "index", "page", "image", "photo", "file", "docs", "http",
              "https", "www", "com", "org", "html", "json", "data", "true", "false", "null", "none", "string", "number",
              "update", "create", "delete", "list", "item", "service", "client", "server", "request", "response",
              "handler", "manager", "factory", "controller", "the", "and", "tion", "ing", "ment", "with", "from", "that",
              "this", "for", "ent", "ble", "ung", "keit", "heit", "schaft", "cion", "mente", "ado", "que", "elle", "eau",
              "ou", "er", "in", "th", "en", "an", "es", "on", "st", "ha", "re", "ti", "le", "de", "ch", "ed", "or", "at")

# Runs are matched whole, whatever their length, and never given back, so the time is linear.
_ASSIGNED = ("(?i:" + "|".join(re.escape(k) for k in KEY_WORDS)
             + r")[\"']?[ \t]{0,3}(?:=|:|=>)[ \t]{0,3}[\"']?(?P<assigned>[^\s\"'<>,;]{6,}+)")
_PATTERN = re.compile("|".join((
    r"(?P<pem>-----BEGIN [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----(?:[^-]++|-(?!----(?:BEGIN|END) ))*+"
    r"-----END [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----)",
    _ASSIGNED,
    r"(?<![A-Za-z0-9_-])(?P<issued>(?:AKIA|ASIA)[0-9A-Z]{16}[A-Za-z0-9]*+|gh[pousr]_[A-Za-z0-9]{36,}+|glpat-[A-Za-z0-9_-]{20,}+"
    r"|xox[abpr]-[A-Za-z0-9-]{10,}+|(?:sk|rk)_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35,}+"
    r"|SG\.[A-Za-z0-9_-]{16,}+\.[A-Za-z0-9_-]{16,}+|eyJ[A-Za-z0-9_-]{10,}+(?:\.[A-Za-z0-9_-]{10,}+){2,}+)",
    r"(?<![A-Za-z0-9+/_=.-])(?P<blob>(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+={0,2})(?![A-Za-z0-9+/_-])",
)))
_SIGNS = ("=", ":", *PREFIXES)
_DIGIT = re.compile("[0-9]")

FINDINGS_TYPE = "array<struct<start:int,end:int,kind:string,candidate:string,score:double>>"
FEATURES = ("length", "letter_digit_turns", "case_turns", "other_turns", "entropy", "digit_share", "upper_share",
            "hex_only", "distinct_share", "coverage", "prefix", "keyword", "assigned", "plain_word", "quoted",
            "path_depth", "path_like", "dashes", "mail_or_host", "repeats")


@dataclass(frozen=True)
class Finding:
    start: int
    end: int
    kind: str
    before: str
    candidate: str
    after: str


def candidates(text: str | None) -> list[Finding]:
    """Candidates of a text in order; they do not overlap. Every pattern needs a digit, an assignment or
    the beginning of an issued key, so most texts are passed over quickly."""
    if not text or not (_DIGIT.search(text) or any(sign in text for sign in _SIGNS)):
        return []
    out = []
    for m in _PATTERN.finditer(text):
        kind = m.lastgroup
        start, end = m.span(kind)
        out.append(Finding(start, end, kind, text[max(0, start - CONTEXT):start], text[start:end], text[end:end + CONTEXT]))
    return out


_COVER = re.compile("|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))))


def _kinds(text: str) -> str:
    return "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in text)


def describe(before: str, candidate: str, after: str) -> list[float]:
    """The FEATURES of a candidate with the text on either side."""
    n = max(len(candidate), 1)
    kinds = _kinds(candidate)
    turns = [a + b for a, b in zip(kinds, kinds[1:]) if a != b]
    steps = max(len(kinds) - 1, 1)
    counts = np.unique(list(candidate), return_counts=True)[1] if candidate else np.ones(1)
    share = counts / counts.sum()
    left = before.split()[-3:] if before else []
    near = re.findall(r"[A-Za-z_-]{2,}|sha1|md5|sha256", " ".join(left).lower())
    tail = before[-24:].lower()
    low = candidate.lower()
    held = sum(len(m) for m in _COVER.findall(low))
    glued = re.search(r"\S*$", before).group(0) + candidate + re.match(r"\S*", after).group(0)
    return [
        math.log(n), sum("d" in t and ("u" in t or "l" in t) for t in turns) / steps,
        sum(t in ("ul", "lu") for t in turns) / steps, sum("o" in t for t in turns) / steps,
        float(-(share * np.log2(share)).sum()), kinds.count("d") / n, kinds.count("u") / n,
        float(re.fullmatch("[0-9a-fA-F-]+", candidate) is not None), len(counts) / n, held / n,
        float(candidate.startswith(PREFIXES)), float(any(k in tail for k in KEY_WORDS)),
        float(re.search(r"[=:][ \t]*[\"']?$", before) is not None), float(any(w in PLAIN_WORDS for w in near)),
        float(before[-1:] in "\"'" and before != "" and after[:1] in "\"'"), float(glued.count("/")),
        float("://" in glued or re.search(r"\.(com|org|net|html?|js|css|png|jpe?g|py|md)\b", glued) is not None),
        float(candidate.count("-")), float("@" in glued or re.fullmatch(r"[\d.]+", candidate) is not None),
        float(counts.max() / n),
    ]


@dataclass
class Forest:
    """Trees as lists of nodes (feature, cut, left, right) or leaves (-1, share of secrets, 0, 0)."""

    trees: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for tree in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                feature = tree[node, 0].astype(np.int64)
                if (feature < 0).all():
                    break
                below = x[rows, np.maximum(feature, 0)] < tree[node, 1]
                node = np.where(feature < 0, node, np.where(below, tree[node, 2], tree[node, 3]).astype(np.int64))
            total += tree[node, 1]
        return total / max(len(self.trees), 1)


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 8, least: int = 3, seed: int = 5) -> Forest:
    """Each tree sees rows drawn with replacement, each split a random third of the features."""
    rng = np.random.default_rng(seed)
    some = max(1, x.shape[1] // 3)

    def grow(rows: np.ndarray, level: int, nodes: list) -> int:
        here = len(nodes)
        share = float(y[rows].mean()) if len(rows) else 0.0
        nodes.append([-1.0, share, 0.0, 0.0])
        if level == depth or len(rows) < 2 * least or share in (0.0, 1.0):
            return here
        best = (1e-12, 0, 0.0)
        for f in rng.choice(x.shape[1], some, replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            value, ones = x[order, f], np.cumsum(y[order])
            at = np.flatnonzero(value[1:] > value[:-1]) + 1
            at = at[(at >= least) & (at <= len(rows) - least)]
            if len(at):
                p, q = ones[at - 1] / at, (ones[-1] - ones[at - 1]) / (len(rows) - at)
                gain = share * (1 - share) - (at * p * (1 - p) + (len(rows) - at) * q * (1 - q)) / len(rows)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), int(f), float((value[at[k]] + value[at[k] - 1]) / 2))
        if best[0] > 1e-12:
            below = x[rows, best[1]] < best[2]
            left, right = grow(rows[below], level + 1, nodes), grow(rows[~below], level + 1, nodes)
            nodes[here] = [float(best[1]), best[2], float(left), float(right)]
        return here

    out = []
    for _ in range(trees if len(y) else 0):
        nodes: list = []
        grow(rng.integers(0, len(y), len(y)), 0, nodes)
        out.append(np.array(nodes))
    return Forest(out)


def labelled_findings(rows: int = 6_000, seed: int = 17) -> list[tuple[str, str, str, int]]:
    """Generated findings (before, candidate, after, 1 for a secret), half of each kind."""
    rng = random.Random(seed)
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    upper, hexa = letters.upper(), digits + "abcdef"
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    syllable = lambda: rng.choice(("th", "er", "in", "an", "on", "tion", "es", "re", "en", "ou", "ble", "ing", "le", "de",
                                   "que", "ment", "ch", "ver", "un", "sch", "ado", "la", "os"))
    word = lambda: "".join(syllable() for _ in range(rng.randint(1, 4)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(0, 6)))
    name = lambda: rng.choice((str, str.upper, str.capitalize))(rng.choice(KEY_WORDS))
    mixed = letters + upper + digits

    def secret() -> tuple[str, str, str]:
        kind = rng.randrange(7)
        before, after = prose() + " ", " " + prose()
        if kind == 0:
            return before, rng.choice(("AKIA", "ASIA")) + pick(upper + digits, 16), after
        if kind == 1:
            issued = rng.choice((("ghp_", 36), ("glpat-", 20), ("sk_live_", 24), ("AIza", 35), ("xoxb-", 40)))
            return before, issued[0] + pick(mixed, issued[1]), after
        if kind == 2:
            part = lambda n: base64.urlsafe_b64encode(rng.randbytes(n)).decode().rstrip("=")
            return before, "eyJ" + part(20) + "." + part(60) + "." + part(32), after
        if kind == 3:
            quote = rng.choice(("", '"', "'"))
            return before + name() + rng.choice(("=", " = ", ": ")) + quote, pick(hexa, rng.choice((16, 18, 20, 32, 40, 64))), quote + after
        if kind == 4:
            quote = rng.choice(("", '"', "'"))
            return before + name() + rng.choice(("=", " = ", ":")) + quote, pick(mixed + "!@#$%^&*", rng.randint(8, 40)), quote + after
        if kind == 5:
            return before + name() + "=", word() + pick(digits + "!#$", rng.randint(2, 5)) + pick(mixed, rng.randint(2, 6)), after
        return before + name() + rng.choice((' = "', ': "')), base64.b64encode(rng.randbytes(rng.randint(16, 48))).decode(), '"' + after

    def other() -> tuple[str, str, str]:
        kind = rng.randrange(12)
        before, after = prose() + " ", " " + prose()
        if kind == 0:
            return before, "-".join(pick(hexa, n) for n in (8, 4, 4, 4, 12)), after
        if kind == 1:
            return before + rng.choice(PLAIN_WORDS) + rng.choice((" ", ": ", "=")), pick(hexa, rng.choice((32, 40, 64))), after
        if kind == 2:
            return before, pick(digits, rng.randint(16, 20)), after
        if kind == 3:
            return before + "https://" + word() + ".com/", "/".join(word() + pick(digits, 2) for _ in range(3)), ".html" + after
        if kind == 4:
            return before, "_".join(word() for _ in range(3)) + pick(digits, rng.randint(1, 4)), after
        if kind == 5:
            return before, "".join(word().capitalize() for _ in range(rng.randint(2, 4))) + pick(digits, 1), after
        if kind == 6:
            return before + name() + "=", rng.choice(("changeme", "your-password-here", "example", "<password>", "xxxxxxxx",
                                                      "********", "${PASSWORD}", "test1234", "os.environ", "None", "password")), after
        if kind == 7:
            return before + name() + ": ", word() + word(), after
        if kind == 8:
            return before + word() + "@", word() + pick(digits, 1) + ".example.com", after
        if kind == 9:
            return before, "-".join((pick(digits, 4), pick(digits, 2), pick(digits, 2))) + "T" + pick(digits, 6) + "Z0", after
        if kind == 10:
            return before, word() + word() + word() + word() + pick(digits, rng.randint(1, 2)), after
        return before + "/assets/", word() + "-" + pick(hexa, 16), rng.choice((".js", ".css", ".png")) + after

    return [(*secret(), 1) if i % 2 else (*other(), 0) for i in range(rows)]


def fit(findings: Iterable[tuple[str, str, str, int]] | None = None, rows: int = FIT_ROWS, **options) -> Forest:
    """Forest from labelled findings; of more than ``rows`` the first ones are used."""
    known = list(findings)[:rows] if findings is not None else labelled_findings()
    x = np.array([describe(b, c, a) for b, c, a, _ in known]).reshape(len(known), len(FEATURES))
    return train(x, np.array([y for *_, y in known], np.float64), **options)


def rated(texts: list[str | None], forest: Forest) -> list[list[tuple[Finding, float]]]:
    found = [candidates(t) for t in texts]
    flat = [f for fs in found for f in fs]
    if not flat:
        return [[] for _ in texts]
    scores = iter(forest.scores(np.array([describe(f.before, f.candidate, f.after) for f in flat])).tolist())
    return [[(f, next(scores)) for f in fs] for fs in found]


def findings(text: str | Column, forest: Forest) -> Column:
    """Array of the candidates of a text with their scores."""

    @F.arrow_udf(FINDINGS_TYPE)
    def scanned(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32(), "kind": pa.string(),
                                   "candidate": pa.string(), "score": pa.float64()}))
        rows = rated(texts.to_pylist(), forest)
        return pa.array([[{"start": f.start, "end": f.end, "kind": f.kind, "candidate": f.candidate, "score": s}
                          for f, s in fs] for fs in rows], kind)

    return scanned(text)


def redacted(text: str | Column, forest: Forest, cut: float = CUT, mark: str = "[secret]") -> Column:
    """The text with each accepted secret replaced by a mark; null stays null."""

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        out = []
        for text, fs in zip(values, rated(values, forest)):
            for f, s in reversed(fs):
                if s >= cut:
                    text = text[:f.start] + mark + text[f.end:]
            out.append(text)
        return pa.array(out, pa.string())

    return cleaned(text)


def scan(docs: DataFrame, forest: Forest | None = None, id_col: str = "doc_id", text_col: str = "text",
         cut: float = CUT) -> DataFrame:
    """``id_col, start, end, kind, candidate, score, is_secret``: every candidate of every row.

    ``start`` and ``end`` count code points from 0. Null and empty texts have no rows; repeated documents
    are reported each. No shuffle. Without labelled findings the forest has no trees and accepts nothing.
    """
    forest = fit() if forest is None else forest
    return docs.select(F.col(id_col).alias("_id"), F.inline(findings(text_col, forest))).select(
        F.col("_id").alias(id_col), "start", "end", "kind", "candidate", "score", (F.col("score") >= cut).alias("is_secret"))


def redact(docs: DataFrame, forest: Forest | None = None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with the secrets in ``text_col`` replaced; all rows and columns stay."""
    forest = fit() if forest is None else forest
    return docs.withColumn(text_col, redacted(text_col, forest, cut))
