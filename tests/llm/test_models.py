"""Quality rules, quality classifier, language identification: statistics, models, odd rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinledger.llm import additive, isolation, op3_quality_rules, op6_language_id, op10_quality_classifier, stats

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [None, "", "  ", "\n\n", "a", "a a a a", "x\ny\nx\n x", "é É |", "a b c a b c\r\na b", "\x1ca b", "1 #2 <x>", "word " * 30_000]
DOCS = "doc_id bigint, text string, lang string, stats string, score double, kept string, label int, step int"


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(triples)
    covered = {i + j for i, t in enumerate(triples) if times[t] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def odd_docs(spark, more=()):
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(3, "\n\n", "en"), (None, "no id", None), *more]
    return spark.createDataFrame([(*r, "s", 0.5, "k", 1, 2) for r in rows], DOCS)


def test_statistics_match_a_plain_count(spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    got = stats.count_table(pa.array(texts, pa.string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, t in enumerate(texts):
        assert tuple(int(got[n][i]) for n in names) == base(t)
    assert np.isfinite(stats.features(got)).all()


def test_statistics_do_not_depend_on_chunks(sf, spark, monkeypatch):
    texts = pa.array([r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()])
    whole = stats.count_table(texts)
    parts = [stats.count_table(texts.slice(i, 7)) for i in range(0, len(texts), 7)]
    for name in stats.COUNTS:
        assert (whole[name] == np.concatenate([p[name] for p in parts])).all()


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = additive.train(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.scores(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.95
    assert ((additive.train(x, np.ones(4000)).scores(x)) > 0.9).all()
    assert np.allclose(additive.train(x[:0], y[:0]).scores(x), 0.5)


def test_isolation_forest_finds_what_stands_apart():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(2000, 4)), rng.normal(size=(20, 4)) + 8])
    score = isolation.grow(x).scores(x)
    assert score[2000:].min() > np.quantile(score[:2000], 0.98)
    assert np.isfinite(isolation.grow(x[:1]).scores(x)).all() and np.isfinite(isolation.grow(x[:0]).scores(x)).all()


def test_quality_rules(spark, sf):
    sf = sf.replace("0.001", "0.01")  # enough labelled rows for a threshold
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = op3_quality_rules.quality_rules(docs, labels).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count()
    for r in got:
        b = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (r.base_failed and r.kept)
    good = [r for r in got if quality.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in got if quality.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(r.kept for r in good) > 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.75 * len(bad)


def test_quality_rules_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(0, 1), (None, 0), (4, None)], "doc_id bigint, quality int")
    got = op3_quality_rules.quality_rules(docs, labels, keep=["lang"]).collect()
    assert len(got) == docs.count() and all(r.kept is not None for r in got)
    assert op3_quality_rules.quality_rules(docs.limit(0), labels).count() == 0


def test_quality_classifier(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = op10_quality_classifier.quality_scores(docs, labels).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in got if r.held_out and r.doc_id in quality]
    assert len(got) == docs.count() and held
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert sum(r.predicted == quality[r.doc_id] for r in held) >= 0.9 * len(held)


def test_quality_classifier_odd_rows(spark):
    docs = odd_docs(spark, [(100 + i, f"text number {i} with words", "en") for i in range(20)])
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(20)] + [(101, 0), (None, 1), (102, None), (103, 7)],
                                   "doc_id bigint, quality int")
    got = op10_quality_classifier.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    kept = op10_quality_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns
    nothing = op10_quality_classifier.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert op10_quality_classifier.quality_scores(docs.limit(0), labels).count() == 0


def test_quality_model_ignores_held_out_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.score) for r in op10_quality_classifier.quality_scores(docs, x).collect())
            for x in (labels, turned))
    assert a == b


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = op6_language_id.identify(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and held
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_odd_rows(spark):
    more = [(100 + i, t, l) for i, (t, l) in enumerate([("the house of the king", "en"), ("das haus des königs", "de"),
                                                        ("дом короля и дом", "ru"), ("王の家は山の上", "ja")] * 6)]
    docs = odd_docs(spark, more)
    got = op6_language_id.identify(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    for i in (0, 1, 2, 3):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[102].lang_pred == "ru" and by_id[103].lang_pred == "ja"
    assert {r.lang_pred for r in op6_language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert op6_language_id.identify(docs.limit(0)).count() == 0


def test_ngram_vectors_are_products_of_permuted_letters():
    v = op6_language_id.Vectors(64, 3)
    letter = {c: v._letter_vector(ord(c)).astype(int) for c in " ab"}
    want = sum(np.roll(letter[x], 2) * np.roll(letter[y], 1) * letter[z] for x, y, z in (" ab", "ab "))
    assert np.allclose(v.bundle(["AB"])[0], want / np.linalg.norm(want), atol=1e-6)
    assert not v.bundle([None])[0].any()


@pytest.mark.parametrize("text", ["ab  cd", "Ab-cD", "\nab cd!"])
def test_letters_fold(text):
    assert "".join(map(chr, op6_language_id.letters(text))) == " ab cd "
