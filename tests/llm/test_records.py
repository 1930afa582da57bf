"""Near-duplicates, site trees, WARC archives and the pipeline: brute force, round trips, odd rows."""

import base64
import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import duck, mismatch
from twinledger.llm import components, op2_order_minhash, op5_site_trees, op9_warc
from twinledger.llm.queries import ORACLES, QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def grouped(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = grouped(links, nodes | {x for p in links for x in p})
    assert got == {n: want[n] for n in nodes}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_read_only_open_links_again(spark, monkeypatch):
    read = []
    real = components.written

    def noted(df, label, *rest):
        out = real(df, label, *rest)
        if label == "open-links":
            read.append(out.count())
        return out

    monkeypatch.setattr(components, "written", noted)
    # two stars, joined by a chain: the stars are done after the first round
    links = [(0, i) for i in range(2, 300)] + [(1000, i) for i in range(1001, 1300)] + [(i, i + 1) for i in range(1299, 1330)] + [(299, 1330)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == dict.fromkeys({x for p in links for x in p}, 0)
    assert len(read) > 1 and read[0] == len(links) and max(read[1:]) < 40 and read[-1] == 0


def test_banded_distance_equals_the_full_matrix():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 60))]
        b = list(a) if rng.random() < 0.7 else [rng.randrange(6) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = [rng.randrange(6)] * rng.randrange(2)
        limit, want = rng.randrange(0, 40), edits(a, b)
        got = op2_order_minhash.banded_distance(np.array(a, np.int32), np.array(b, np.int32), limit)
        assert got == (want if want <= limit else -1)


def test_sketches_see_order_and_occurrence(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [(0, " ".join(words)), (1, "\n".join(words)), (2, " ".join(words[100:] + words[:100])), (3, "a b"), (4, "b a"), (5, None)]
    rows = {r.i: r.s for r in spark.createDataFrame(texts, "i int, text string").select(
        "i", op2_order_minhash.order_sketches("text").alias("s")).collect()}
    assert rows[0]["keys"] == rows[1]["keys"] and rows[3]["keys"] != rows[4]["keys"] and rows[5]["n"] == 0
    same = sum(a == b for a, b in zip(rows[0]["keys"], rows[2]["keys"]))
    assert same < op2_order_minhash.SKETCHES  # moved halves keep most shingles but not their order


def brute_classes(rows):
    """Classes over all pairs."""
    texts = {}
    for i, t in rows:
        if i is not None and t is not None:
            texts.setdefault(i, t)
    words = {i: np.array([hash(w) & 0x7FFFFFFF for w in WORD.findall(t)], np.int64).astype("<i4") for i, t in texts.items()}

    def near(a, b):
        limit = int(0.2 * max(len(a), len(b)) + 1e-9)
        bound = np.abs(op2_order_minhash.histogram(a) - op2_order_minhash.histogram(b)).sum()
        return bound <= 2 * limit and op2_order_minhash.banded_distance(a, b, limit) >= 0

    ids, links = sorted(texts), []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if texts[a] == texts[b] or (len(words[a]) and len(words[b]) and near(words[a], words[b])):
                links.append((a, b))
    return grouped(links, ids)


def copies(rng, words, n, rate):
    out = []
    for _ in range(n):
        new = list(words)
        for _ in range(max(1, int(rate * len(words)))):
            new[rng.randrange(len(new))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(new))
    return out


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op2_order_minhash, "BLOCK", 4)  # many blocks
    rng = random.Random(5)
    fresh = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    shared = fresh(40)
    texts = [None, "", "", " ", "one", "one", "two words", "long " * 30_000, "long " * 30_001]
    for n in (30, 80, 300, 1200):
        words = fresh(n)
        texts += [" ".join(words)] * 2 + copies(rng, words, 6, 0.03) + copies(rng, words, 2, 0.6)
    base = fresh(120)
    texts += copies(rng, base, 40, 0.05)  # a group without its original
    texts += [" ".join(shared + fresh(25)) for _ in range(40)]  # a passage in many documents
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    odd = [(3, ""), (rows[12][0], rows[12][1]), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "k", 1, "n") for i, t in rows + odd], "doc_id bigint, text string, key string, n int, node string")
    got = op2_order_minhash.near_duplicates(docs).collect()
    want = brute_classes(rows)
    assert {r.doc_id: r.class_id for r in got} == want
    assert Counter(r.doc_id for r in got) == Counter(i for i, t in rows + odd if i is not None and t is not None)
    kept = op2_order_minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([*{c for c in want.values()}, *[i for i, t in rows if t is None], None, None])
    assert op2_order_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_up_to_the_limit(spark):
    rng = random.Random(11)
    texts = []
    for n in (*range(2, 40), 47, 55, 60, 61, 80, 150, 300, 700):
        for rate in (0.1, 0.15, 0.2):
            words = [f"u{rng.randrange(10**6)}" for _ in range(n)]
            new = list(words)
            for at in rng.sample(range(n), int(rate * n + 1e-9)):
                new[at] = f"n{rng.randrange(10**6)}"
            shorter = list(words)
            for at in sorted(rng.sample(range(n), int(rate * n + 1e-9)), reverse=True):
                del shorter[at]
            texts += [" ".join(words), " ".join(new)]
            if n > 4:  # only edits of the middle word
                texts += [" ".join([*words[:n // 2], "other", *words[n // 2 + 1:]])]
            texts += [" ".join(["z", *shorter])]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in op2_order_minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)


def test_unlike_documents_of_a_bucket_are_told_apart_once(spark, monkeypatch):
    listed = []
    real = op2_order_minhash.written

    def noted(df, label, *rest):
        out = real(df, label, *rest)
        if label == "candidates":
            listed.append(out.count())
        return out

    monkeypatch.setattr(op2_order_minhash, "written", noted)
    rng = random.Random(7)
    fresh = lambda n: [f"p{rng.randrange(10**6)}" for _ in range(n)]
    shared, two = fresh(300), fresh(100)
    # a passage that is not enough, in texts of many lengths; and two texts that nobody else shares a sketch with
    texts = [" ".join(shared + fresh(n)) for n in (200, 95, 130, 160, 100, 145, 110, 180)]
    rows = list(enumerate([*texts, " ".join(two), " ".join(two[:70] + fresh(20))]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in op2_order_minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows) and len(set(got.values())) == len(rows)
    assert listed == [0]


def test_a_document_s_signature_is_joined_once_and_meets_every_near_length(spark, monkeypatch):
    monkeypatch.setattr(op2_order_minhash, "BLOCK", 4)
    rng = random.Random(3)
    rows = [(key, node, 40 + node % 7 * 12, node % 5 if node % 3 else -1, node % 3 > 0)
            for key, size in ((1, 60), (2, 2), (3, 4), (4, 30)) for node in rng.sample(range(80), size)]
    rows += [(5, node, 50, -1, False) for node in range(6)]  # nobody is apart
    sided = spark.createDataFrame(rows, "key bigint, node bigint, n int, component bigint, apart boolean")
    found = op2_order_minhash.memberships(sided).collect()
    blocks = {}
    for r in found:
        for of in r.buckets:
            for b in of.blocks:
                blocks.setdefault((of.key, b.low, b.high), []).append((r.node, b.upper))
    assert len({r.node for r in found}) == len(found) == len({row[1] for row in rows if row[0] in (1, 3, 4)})
    assert not {key for key, *_ in blocks} & {2, 5}
    met = Counter((key, *sorted((a, b))) for (key, low, high), of in blocks.items()
                  for a, up in of for b, other in of if a < b and (low == high or up != other))
    for key, a, n, c, x in rows:
        for other, b, m, d, y in rows:
            if key == other and a < b and key in (1, 3, 4) and c != d and (x or y) and min(n, m) >= 0.8 * max(n, m):
                assert met[key, a, b] == 1
    cells = {cell for key, *ends in blocks if key == 1 for cell in ends}
    assert len([key for key, *_ in blocks if key == 1]) < len(cells) * (len(cells) + 1) / 2


@pytest.mark.parametrize("n", [1, 100, op2_order_minhash.FINE_BINS // 2 - 1, op2_order_minhash.FINE_BINS // 2, 9000])
def test_signatures_tell_more_words_apart(n):
    words = np.random.default_rng(n).integers(0, 1 << 31, n).astype("<i4")
    words[: n // 2] = 7  # more than a packed count holds
    packed = op2_order_minhash._packed_bins(words)
    got = op2_order_minhash._histograms([packed, packed], np.array([n, n]))
    want = np.minimum(np.bincount(words % op2_order_minhash.FINE_BINS, minlength=op2_order_minhash.FINE_BINS), 255)
    assert op2_order_minhash.FINE_BINS >= 4096 and (got == want).all() and len(packed) <= op2_order_minhash.FINE_BINS


def test_shuffle_files_of_each_step_are_dropped(spark, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, seen, real = spark.conf.get(name), {}, op2_order_minhash.written
    monkeypatch.setattr(op2_order_minhash, "written", lambda df, label, *rest: seen.update({label: spark.conf.get(name)}) or real(df, label, *rest))
    text = "some words that come twice in a row of texts"
    docs = spark.createDataFrame([(i, text + " and more" * (i % 2)) for i in range(4)], "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in op2_order_minhash.near_duplicates(docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 0}
    assert set(seen.values()) == {"true"} and {"sketches", "words", "candidates", "final"} <= set(seen)
    assert spark.conf.get(name) == was


def test_alignment_takes_bands_wider_than_the_texts():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 30))] for _ in "ab")
        want = edits(a, b)
        for band in {abs(len(a) - len(b)), want, want + 1, 40}:
            found = op2_order_minhash._in_band(np.array(a, np.int32), np.array(b, np.int32), band)
            assert found == want if want <= band else found > band


def test_near_duplicates_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op2_near_duplicates"](spark, sf).collect()}
    assert got == brute_classes(rows)


# pages

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">cookies</div><nav><ul><li><a href=x>menu</a></ul></nav><main><h1>A &amp; B &lt;</h1><!-- note -->
<p>one  two<br>three<p>four <b>five</b>six<aside>no</aside><ul><li>x<li>y</ul><form>f<input value=1></form>
<script>var t="</p>";</script><section class="comments"><article class="comment">bad</article></section></main>
<footer>&copy; foot</footer>"""


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<script>x", ""),
    (PAGE, "A & B <\none two three\nfour fivesix\nx\ny"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<article>x&am</article>", "x&am"),
    ("<article><p>first</article><div>off</div><article>second</article>", "first\nsecond"),
    ("<body><p>&#233;&nbsp;&#x41;\t\n z</p>", "é A z"), ("</p></div>lost", "lost"),
    ("<b>" * 3000 + "deep", "deep"),
])
def test_main_text(html, want):
    assert op5_site_trees.main_text(html, frozenset()) == want


@pytest.mark.parametrize("html, want", [
    ("<body class='no-sidebar'><div id=page class='has-sidebar'><article><p>x</p></article></div>", "x"),
    ("<div class='content-with-menu'><p>a</p></div>", "a"), ("<div class='sidebar main'><main>x</main></div>", "x"),
    ("<article><div class='entry-header'><h1>t</h1></div><h2 class='section-header'>s</h2><p>x</p></article>", "t\ns\nx"),
    ("<article><div class=header><h1>t</h1><p>lead</p></div><div class=header><h2 class=header>s</h2></div></article>", "t\nlead\ns"),
    ("<article><p class='social-policy'>a<p class='job-search'>b<p class='ad-hoc'>c</article>", "a\nb\nc"),
    ("<article><p>x</p><div class='big ad'>y</div><div role=search><p>z</p></div></article>", "x"),
])
def test_names_of_furniture(html, want):
    assert op5_site_trees.main_text(html, frozenset()) == want


def test_site_tree_removes_what_is_alike_on_all_pages(spark):
    rows = [(i, f"http://a.example/{i}", f"<body><div class=top>Same line</div><div class=text><p>Own words {i} and {i * i}</p></div>"
             f"<div class=end><p>Read more here</p></div></body>", "h") for i in range(30)]
    rows += [(100, "http://b.example/1", "<body><div class=top>Same line</div><p>other</p></body>", "h"), (101, None, None, None),
             (101, None, None, None), (102, "no url", "<p>x</p>", "h"), (103, "http://A.example/x", rows[0][2], "h")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    for limit in (10**6, 0):  # broadcast, and joined by host
        got = op5_site_trees.extract(pages, broadcast_rows=limit).collect()
        assert len(got) == len(rows)
        text = {r.page_id: r.text for r in got}
        assert all(text[i] == f"Own words {i} and {i * i}" for i in range(30))
        assert text[100] == "Same line\nother" and text[101] == "" and text[102] == "x" and text[103] == text[0]
        assert all(r.n_chars == len(r.text) for r in got)
    assert op5_site_trees.extract(pages.limit(0)).count() == 0


def test_site_tree_decides_inside_and_outside_articles(spark):
    notice, share = "Subscribe to our letter and read more of what we write every day", "Tell your friends about this page"
    body = lambda i, own: (f"<body><main><p>{own}</p><p>{notice}</p><div>{share}</div></main>"  # noqa: E731
                           f"<div class=more><p>Long outside text {i} of its own</p></div><div class=end><p>All the same</p></div></body>")
    rows = [(i, "http://a.example/", body(i, f"Own words {i}")) for i in range(30)]
    # one article on many pages of a host is not boilerplate, nor are near copies of another one
    rows += [(100 + i, "http://b.example/", "<article><h1>Copied</h1><p>The same text</p></article>") for i in range(30)]
    same = "".join(f"<p>{'paragraph ' * 9}{j}</p>" for j in range(6))
    rows += [(200 + i, "http://c.example/", f"<article>{same}<p>changed {i}</p></article>") for i in range(40)]
    rows += [(300 + i, "http://c.example/", f"<article><p>text {i} one</p><p>text {i} two</p></article>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for limit in (10**6, 0):
        text = {r.page_id: r.text for r in op5_site_trees.extract(pages, broadcast_rows=limit).collect()}
        assert all(text[i] == f"Own words {i}\nLong outside text {i} of its own" for i in range(30))
        assert all(text[100 + i] == "Copied\nThe same text" for i in range(30))
        assert all(text[200 + i].endswith(f" 5\nchanged {i}") and text[200 + i].count("\n") == 6 for i in range(40))
        assert all(text[300 + i] == f"text {i} one\ntext {i} two" for i in range(60))


def test_pages_of_the_table(spark, sf):
    import html as H

    got = {r.page_id: r.text for r in QUERIES["op5_main_text"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        parts = [H.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))) for b in re.split(r"</?(?:h1|p)>", article)]
        parts = [re.sub(r"\s+", " ", p).strip() for p in parts]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


# archives

@pytest.fixture()
def pages(spark):
    rng = random.Random(1)
    bodies = [None, "", "x", "é" * 5000, "a\r\n\r\nWARC/1.0\r\n\r\n", "".join(rng.choice("abc\n") for _ in range(300_000)), "x" * 65_536]
    rows = [(i, f"http://h/{i} \r\n", b) for i, b in enumerate(bodies)] + [(20 + i, None, b) for i, b in enumerate(bodies)] + [(5, "again", "x")]
    return spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id bigint, url string, html string, data string, chunk_no int")


def test_archives_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/warc"
    files = op9_warc.archive(pages, folder)
    rows = pages.collect()
    for chunk_bytes in (1000, 1 << 16):
        chunks = op9_warc.read_archives(files, chunk_bytes).collect()
        assert max(len(c.data) for c in chunks) <= chunk_bytes
        body = {}
        for c in sorted(chunks, key=lambda c: c.chunk_no):
            if c.record_type == "response":
                body.setdefault(c.record_id, bytearray()).extend(c.data)
                if c.is_last and c.record_id != "<urn:page:5>":
                    got = bytes(body[c.record_id])
                    assert c.bytes_so_far == len(got)
                    assert c.digest_so_far == c.stated_digest == base64.b32encode(hashlib.sha1(got).digest()).decode()
    records = op9_warc.records_of(op9_warc.read_archives(files)).collect()
    assert len(records) == len(rows) and all(r.intact for r in records)
    # the files are gzip members of plain records
    first = files.first().path.removeprefix("file://")
    assert gzip.open(first).read(8) == b"WARC/1.0"
    assert sum(r.n_records for r in files.collect()) == len(rows)


def test_revisits(spark, pages):
    got = {}
    for r in op9_warc.with_revisits(pages).collect():
        got.setdefault(r.page_id, r.refers_to)
    assert got[1] == 0 and got[20] == 0 and got[21] == 0 and got[22] == 2 and got[23] == 3 and got[0] is None
    larger = {r.page_id: r.refers_to for r in op9_warc.with_revisits(pages, min_bytes=2).collect()}
    assert larger[1] is None and larger[22] is None and larger[23] == 3
    assert op9_warc.records_of(op9_warc.read_archives(op9_warc.archive(pages.limit(0)))).count() == 0


def test_files_of_failed_attempts_are_not_read(spark, pages, tmp_path):
    files = op9_warc.archive(pages, f"file://{tmp_path}/warc")
    (tmp_path / "warc" / "part-left-behind.warc.gz").write_bytes(b"half a rec")
    assert op9_warc.records_of(op9_warc.read_archives(files)).count() == pages.count()


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, sf, name):
    assert mismatch(duck(sf), QUERIES[name](spark, sf), ORACLES[name]) is None


# pipeline

def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    have, texts = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, have, sf)
        assert after.columns == docs.columns
        texts[name] = {r.doc_id: r.text for r in after.collect()}
        have = spark.createDataFrame(after.collect(), docs.schema)
    names = [n for n, _ in corpus_pipeline.STAGES]
    # near-duplicates: one document of each brute-force class of what the first stage kept
    classes = brute_classes(list(texts[names[0]].items()))
    assert set(texts[names[1]]) == set(classes.values())
    assert set(texts[names[2]]) <= set(texts[names[1]]) and set(texts[names[3]]) == set(texts[names[2]])
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(i in t for t in texts[names[2]].values() for i in items)
    assert not any(re.search("AKIA[0-9A-Z]{16}", t) for t in texts[names[3]].values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in texts[names[0]] for i in good) >= 0.97 * len(good)
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == set(texts[names[3]])


def test_pipeline_odd_rows(spark, tmp_path, sf):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "x y z", "en", "s", 5), (2, "", "en", "s", 0), (2, "", "en", "s", 0)] + [
            (10 + i, f"text {i} of some words that are kept", "en", "s", 40) for i in range(5)],
        spark.read.parquet(f"{sf}/documents.parquet").schema)
    for table in (docs, docs.limit(0)):
        folder = str(tmp_path / f"t{table.count()}")
        table.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(10, 1, 0), (11, 0, 0), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
        assert corpus_pipeline.run(spark, folder).select(F.count("*")).first()[0] >= 0


def test_archives_are_read_by_many_tasks_and_null_ids_pass(spark, tmp_path):
    files = spark.range(100).select(F.concat(F.lit(f"file://{tmp_path}/"), "id").alias("path"))
    read = op9_warc.read_archives(files)
    dealt = re.search(r"hashpartitioning\(path#\d+, (\d+)\), REPARTITION_BY_NUM", read._jdf.queryExecution().toString())
    assert dealt and int(dealt[1]) == 100
    pages = spark.createDataFrame([(None, "http://a/x", "<p>1</p>"), (1, None, None), (2, "http://a/y", "<p>1</p>"),
                                   (3, "http://a/z", "<p>1</p>")], "page_id bigint, url string, html string")
    pages.write.parquet(f"file://{tmp_path}/t/pages.parquet")
    found = QUERIES["op9_warc_archives"](spark, f"file://{tmp_path}/t").collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in found) == [
        ("1", 0, "response", None), ("2", 8, "response", None), ("3", 8, "revisit", 2), ("None", 8, "response", None)]
