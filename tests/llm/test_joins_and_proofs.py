"""Merkle manifest, n-gram join and token alignment against plain versions."""

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.oracle import duck, mismatch
from twinledger.llm import op11_merkle_manifest as M
from twinledger.llm import op12_ngram_join as N
from twinledger.llm import op13_token_alignment as A
from twinledger.llm.queries import load

N_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("name", ["op11_merkle_manifest_proofs", "op12_ngram_components"])
def test_equal_to_sql(spark, sf, name):
    queries, sql = load()
    assert mismatch(duck(sf), queries[name](spark, sf), sql[name]) is None


# -- manifest ------------------------------------------------------------------


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for t, g in enumerate(langs):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, proof = leaf_of((*r[:3], r[3] + 1, r[4])) if hit else leaf, []
            for levels, at in ((trees[g], i), (top, t)):
                for level in levels[:-1]:
                    pair = level[at // 2 * 2:at // 2 * 2 + 2]
                    others = [x for j, x in enumerate(pair) if j != at % 2]
                    proof += others
                    node = h(*[node if j == at % 2 else x for j, x in enumerate(pair)])
                    at //= 2
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], h(*proof), node, node == top[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("sizes", [[1], [2, 1], [255, 256, 257, 1], [600, 5]])
def test_manifest_equals_plain(spark, sizes):
    rnd, rows = random.Random(sum(sizes)), []
    for g, n in enumerate(sizes):
        for i in range(n):
            rows.append((rnd.randrange(3 * n), rnd.choice([None, "web"]), [None, "de", "ä", "fr"][g],
                         rnd.choice([None, 5]), rnd.choice([None, "", "text 日本 " * rnd.randrange(3)])))
    rows += [rows[0], rows[0], (None, None, rows[0][2], None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    docs = docs.withColumn("tree", F.lit(1)).withColumn("rank", F.lit("x"))  # names the operator uses itself
    got = Counter(tuple(r) for r in M.document_manifest(docs).collect())
    assert got == plain_manifest(rows)


def test_log_positions_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(700)], "key bigint, text string")
    made = M.manifest(docs.select("key", F.lit("a").alias("group"), M.row_digest([F.col("key")]).alias("leaf"),
                                  F.lit(None).cast("binary").alias("altered")))
    rows = M.log_entries(made).collect()
    levels = tree([leaf_of((i,)) for i in range(700)])
    assert sorted(r.position for r in rows) == list(range(sum(map(len, levels))))
    assert all(r.digest.hex() == levels[r["level"]][r["index"]] and M.position(r["level"], r["index"], 700) == r.position for r in rows)
    assert M.document_manifest(spark.createDataFrame([], DOCS)).count() == 0


# -- n-gram join ---------------------------------------------------------------


def shingles(text):
    words = N_WORDS.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else [tuple(words[i:i + 5]) for i in range(len(words) - 4)])





def plain_join(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            met = len(a & sets[j])
            if a and sets[j] and 100 * met >= 80 * (len(a) + len(sets[j]) - met):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_join_equals_plain(spark, monkeypatch):
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(400)}"
    passage = " ".join(word() for _ in range(60))
    rows = [(None, None), (None, "a b c"), (1, ""), (2, " \n\t"), (3, "A b C"), (3, "other words here"), (4, "x" * 3000),
            (5, " ".join(word() for _ in range(6000))), (6, "a b c d e"), (7, "a b c d E"), (7, "a b c d e f")]
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([6, 9, 12, 30, 80, 200]))]
        for _ in range(rnd.choice([2, 3, 8, 30])):
            copy = list(base)
            for _ in range(rnd.randrange(1 + len(base) // 12)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((rnd.randrange(10_000), " ".join(copy)))
    rows += [(20_000 + i, passage + " " + " ".join(word() for _ in range(rnd.randrange(8, 40)))) for i in range(40)]
    rows += [rows[20]] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("no", F.lit(1)).withColumn("key", F.lit("x"))
    want = plain_join(rows)
    assert Counter(tuple(r) for r in N.ngram_join(docs).collect()) == want
    monkeypatch.setattr(N, "BLOCK", 4)  # long lists are searched in blocks, common shingles come last
    assert Counter(tuple(r) for r in N.ngram_join(docs).collect()) == want


def test_join_parses_texts_of_open_pairs_only_and_tidies_up(spark, tmp_path, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, parsed, on = spark.conf.get(name), [], []
    real = N.written

    def noted(df, label, *rest):
        out = real(df, label, *rest)
        if label == "needed-rows":
            parsed.append({r["_id"] for r in out.collect()})
            on.append(spark.conf.get(name))
        return out

    monkeypatch.setattr(N, "written", noted)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i] + ["x"] + base[i + 1:])) for i in range(6)] + [(9, "not alike at all, this one"), (None, " ".join(base))]
    assert Counter(tuple(r) for r in N.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()) == plain_join(rows)
    assert parsed and parsed[0] == {0, 1, 2, 3, 4, 5, None}
    assert on and set(on) == {"true"} and spark.conf.get(name) == before


def test_join_of_an_empty_table(spark):
    assert N.ngram_join(spark.createDataFrame([], DOCS)).count() == 0


# -- alignment -----------------------------------------------------------------

TEXTS = [None, "", "a", "hello world", "  two  spaces\n\n\tx", "日本語 混合 abc", "▁mark", "<s></s><|endoftext|> <unk>",
         "x" * 300 + " " * 50, "é́ ñ 😀", "\0nul", "a\r\nb", "hello world", "The cat's 12 dogs; naïve coöperation"]


def plain_alignment(texts):
    made, rows, docs_of = A.sides(), [], Counter()
    for text in texts:
        a, b = made.tokens(text)
        cut = []
        for ids, spelled in ((a, made.a_bytes), (b, made.b_bytes)):
            at, out = 0, []
            for i in ids.tolist():
                at += len(spelled[i])
                out.append((at, i))
            cut.append(out)
        common = sorted({e for e, _ in cut[0]} & {e for e, _ in cut[1]})
        groups = [([], []) for _ in common]
        for side in (0, 1):
            for e, i in cut[side]:
                groups[bisect_left(common, e)][side].append(i)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        docs_of.update(links.keys())
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        rows.append((len(a), len(b), len(groups), links, h(shown) if shown else ""))
    most = Counter()
    for (x, _), n in docs_of.items():
        most[x] = max(most[x], n)
    return [(na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if docs_of[p] == most[p[0]]),
             sum(n * docs_of[p] for p, n in links.items()), sha) for na, nb, ng, links, sha in rows]


@pytest.mark.parametrize("limit", [A.BROADCAST_PAIRS, 5])
def test_alignment_equals_plain(spark, limit):
    rnd = random.Random(2)
    texts = TEXTS + ["".join(rnd.choice("ab cé日😀 \n<0xAB>.,'s12") for _ in range(rnd.randint(1, 50))) for _ in range(60)]
    docs = spark.createDataFrame([(i // 2 if i else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    docs = docs.withColumn("pair", F.lit(1)).withColumn("_row", F.lit(1))
    got = A.align_documents(docs, broadcast_pairs=limit).collect()
    want = Counter((i // 2 if i else None, *w) for i, w in enumerate(plain_alignment(texts)))
    assert Counter(tuple(r) for r in got) == want
    assert got[0].asDict().keys() == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}


def test_alignment_of_an_empty_table(spark):
    assert A.align_documents(spark.createDataFrame([], DOCS)).count() == 0
    assert A.groups(spark.createDataFrame([(1, "hello")], "doc_id int, text string")).first().groups.count("|") >= 1


def test_only_groups_with_several_tokens_on_both_sides_are_counted(monkeypatch):
    seen, real = [], A._counted
    monkeypatch.setattr(A, "_counted", lambda group, ids: seen.append((group, ids)) or real(group, ids))
    rnd = random.Random(8)
    texts = TEXTS + [" ".join(rnd.choice(["the", "cat", "xxxx", "naïve", "日本", "12", "..", "qzj"]) for _ in range(80)) for _ in range(20)]
    got = A.align(texts, A.sides())
    want = plain_alignment(texts)
    assert got["n_links"].tolist() == [w[3] for w in want] and got["n_groups"].tolist() == [w[2] for w in want]
    (group_a, _), (group_b, _) = seen
    for group in (group_a, group_b):
        assert all(n > 1 for n in Counter(group.tolist()).values())
    assert set(group_a.tolist()) == set(group_b.tolist())
    assert 0 < len(group_a) < got["n_a"].sum() and len(group_b) < got["n_b"].sum()


def test_overlaps_are_all_overlaps():
    made = A.sides()
    texts = ["naïve coöperation 日本 <0xAB>", "plain words here"]
    ids = list(zip(*map(made.tokens, texts)))
    import numpy as np
    base = np.array([0, int(made.a_length[ids[0][0]].sum())])
    a, b = (A._ranges(x, n, base, s) for x, n, s in ((ids[0], made.a_length, "a"), (ids[1], made.b_length, "b")))
    want = {(x, y) for x, (s, e) in enumerate(zip(a["at"], a["a_end"])) for y, (t, f) in enumerate(zip(b["at"], b["b_end"])) if s < f and t < e}
    found = A.overlaps(a, b)
    assert len(found) == len(want) and set(zip(found["a"], found["b"])) == want
