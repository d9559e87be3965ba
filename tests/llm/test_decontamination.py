import hashlib
import random
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from matchlake.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    words, hit, found = split(text), set(), set()
    for item, item_text in items:
        w = split(item_text)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            for b in range(len(words) - n + 1):
                if words[b:b + n] == w[a:a + n]:
                    hit |= set(range(b, b + n))
                    found.add("" if item is None else str(item))
    ids = sorted(found)
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def run(spark, docs, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.decontaminate(docs, bench, **more).select("doc_id", "leak.*").collect()
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got}


def cases():
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "é", "D9", "x"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.choice([1, 3, 9, 10, 11, 25]))) for k in range(3, 14)] + [(None, "lonely words x x x"), (50, None), (51, ""), (3, say(12))]
    texts = [None, "", "...", "A", say(4)] + [say(60) for _ in range(12)]
    for k in range(6):
        cut = (items[k][1] or "").split()
        texts.append(say(5) + " - " + ", ".join(w.upper() for w in cut) + ". " + say(5))
    return texts + [texts[-1]], items


def test_against_brute_force(spark, make_docs):
    texts, items = cases()
    ids = list(range(len(texts)))
    want = {i: brute(t, items) for i, t in zip(ids, texts)}
    assert run(spark, make_docs(texts), items) == want
    assert run(spark, make_docs(texts), items, block_words=20) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=30), min_size=1, max_size=4), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), min_size=1, max_size=4))
def test_shards_against_brute_force(docs, items):
    named = [(str(k), [w.encode() for w in item]) for k, item in enumerate(items)]
    got = D.scan([" ".join(d).encode() for d in docs], D.TestSuffixes(named))
    for d, (n, spans, found) in zip(docs, got):
        want = brute(" ".join(d), [(k, " ".join(item)) for k, item in enumerate(items)])
        assert (n, sum(b - a for a, b in spans), len(found), bool(spans)) == (want[0], want[1], want[2], want[4])


def test_suffixes_are_sorted():
    import numpy as np
    tests = D.TestSuffixes([("1", [b"a", b"b", b"a", b"b", b"c"])], window=3)
    ids = np.array([tests.vocabulary.get(w, 0) for w in b"a b a b c x a b a b c".split()] + [0], dtype=np.int32)
    at, keys = D.suffix_array(ids, tests)
    order = list(zip(*[k.tolist() for k in keys]))
    assert order == sorted(order) and len(at) > 3
    lo, hi = D.search(keys, tests.low, False), D.search(keys, tests.high, True)
    assert (hi - lo).tolist() == [2, 2, 2]


def test_empty_tables_and_clashing_columns(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs(["a b c"]).withColumn("leak", F.lit(1)).withColumn("item_ids", F.lit("x"))
    got = D.decontaminate(docs, none)
    assert got.columns[:5] == docs.columns[:5] and not got.select("leak.contaminated").first()[0]
    assert D.decontaminate(make_docs([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    kept = D.keep_clean(docs, spark.createDataFrame([(1, "B")], "item_id long, text string"))
    assert kept.count() == 0 and kept.columns == docs.columns


def test_very_long_text(spark, make_docs):
    text = "w " * 300000 + "a b c d e f g h i j " + "w " * 300000
    got = D.decontaminate(make_docs([text]), spark.createDataFrame([(7, "A b c d e f g h i J")], "item_id long, text string"))
    assert [(s.start, s.stop) for s in got.select("leak.spans").first()[0]] == [(300000, 300010)]
