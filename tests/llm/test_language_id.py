import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import language_id
from matchlake.llm.common import fold

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def filters(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return language_id.fit(docs.where(fold("doc_id", 4) != 2))


def test_held_out_accuracy(spark, filters):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(fold("doc_id", 4) == 2)
    seen = language_id.identify(docs, filters).select("lang", "language.*").collect()
    assert sum(r.lang == r.lang_pred for r in seen) / len(seen) > 0.97
    assert all(0 <= r.score <= 1 for r in seen)


def test_filter_masks_equal_single_filters(filters):
    hashed = language_id.mix(np.arange(5000, dtype=np.uint64))
    mask = filters.languages(hashed)
    for k in range(len(filters.langs)):
        bit = np.ones(len(hashed), dtype=bool)
        for at in filters.rows(hashed):
            bit &= ((filters.table[at] >> k) & 1).astype(bool)
        assert (bit == ((mask >> k) & 1).astype(bool)).all()
    assert all(abs(float(((mask >> k) & 1).mean()) - filters.false_rate[k]) < 0.01 for k in range(len(filters.langs)))


def test_ngrams_do_not_cross_texts():
    points, owner = language_id.normal([b"ab", b"cd", None, b""])
    hashed, of = language_id.ngrams(points, owner, 3)
    assert np.bincount(of, minlength=4).tolist() == [2, 2, 0, 0]
    alone = [language_id.ngrams(*language_id.normal([t]), 3)[0].tolist() for t in (b"ab", b"cd")]
    assert hashed.tolist() == alone[0] + alone[1]


def test_odd_texts(make_docs, filters):
    long = "the and of that " * 40000
    docs = make_docs([None, "", "123 !?", "the the the and of that", "the the the and of that", long], [1, 2, 3, 4, 4, None]) \
        .withColumn("language", F.lit("clash"))
    got = language_id.identify(docs, filters).orderBy("doc_id").select("doc_id", "language.*").collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(by[i].score == 0 for i in (1, 2, 3))
    assert by[None].lang_pred in filters.langs and by[4].lang_pred in filters.langs
    kept = language_id.keep_identified(docs, filters)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4, None}


def test_nothing_learned(make_docs):
    empty = language_id.fit(make_docs([]))
    assert empty.langs == []
    got = language_id.identify(make_docs(["a b"]), empty).select("language.*").first()
    assert got.lang_pred == "und" and got.score == 0
    assert language_id.identify(make_docs([]), empty).count() == 0
    assert language_id.keep_identified(make_docs(["a b"]), empty).count() == 1


def test_rare_languages_are_learned_at_every_size(make_docs):
    """One text of a language among many others, and one text on most rows."""
    polish, english = "zażółć gęślą jaźń oraz żółw", "the cat sat on the mat and the dog ran"
    for n in (40, 60, 300):
        texts = [f"{english} number {chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)] + [english] * n + [polish]
        docs = make_docs(texts, langs=["en"] * (2 * n) + ["pl"])
        filters = language_id.fit(docs, fit_rows=50)
        got = {r.text: r.language for r in language_id.identify(docs, filters).select("text", "language").collect()}
        assert got[polish].lang_pred == "pl" and got[polish].score > 0.9
        assert all(v.lang_pred == "en" for t, v in got.items() if t != polish)
