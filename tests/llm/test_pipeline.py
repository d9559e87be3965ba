import random

import pytest

import corpus_pipeline
from matchlake.llm.common import staged


def say(rng, lang, n):
    stems = {"en": ["the", "and", "tion", "ing", "her"], "de": ["der", "und", "ung", "sch", "lich"]}[lang]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, make_docs, tmp_path_factory):
    """Clean texts in two languages, and one of each kind of text that a stage must drop."""
    rng = random.Random(8)
    texts = [say(rng, "en" if k % 2 else "de", 80) for k in range(160)]
    langs = ["en" if k % 2 else "de" for k in range(160)]
    toxic = {k for k in range(160) if k % 8 == 3}
    for k in toxic:
        texts[k] += " awful swine you awful swine"
    texts += ["12345 !!", None, texts[10], texts[12].replace(".", ",") + " x", texts[14] + " " + "alpha beta gamma delta one two three four five six"]
    langs += ["en"] * 5
    path = str(tmp_path_factory.mktemp("corpus"))
    make_docs(texts, None, langs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k in toxic), 1) for k in range(160)], "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "Alpha beta gamma delta one two three four five six")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, toxic


def test_stages(spark, folder):
    path, toxic = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, path))
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert set(range(165)) - kept[0] == {160, 161}
    assert kept[0] - kept[1] == toxic
    assert kept[1] - kept[2] == {162, 163, 164} or kept[1] - kept[2] == {162, 163}
    assert 164 not in kept[3] and kept[3] >= set(range(160)) - toxic
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert {r.doc_id for r in packed.collect()} == kept[3]


def test_run_and_registration(spark, folder):
    import __spark_entry__ as entry
    path, toxic = folder
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, path).select("doc_id").distinct().count() == 160 - len(toxic)
    assert sorted(k.split("_")[0] for k in entry.queries() if k.startswith("op")) == sorted(f"op{k}" for k in range(1, 14))


def test_empty_table(spark, make_docs, folder):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder[0])
        assert out.count() == 0
