import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from matchlake.llm import source_divergence as sd

WORDS = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = T.StructType([T.StructField(n, T.StringType()) for n in ("text", "lang", "source", "term", "counts")])


def brute(rows, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    documents, groups = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = WORDS.findall(text.translate(LOWER))
        documents[lang].update(set(found))
        groups[lang, source].update(found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in documents[lang].items() if n >= 3), key=lambda t: t.encode())
        mine = {s: c for (g, s), c in groups.items() if g == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(c) for s, c in mine.items()}
        q = shares(sum(mine.values(), Counter()))
        for s in mine:
            apart = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept) for o in mine if o != s}
            marks = {t: (p[s][t] - q[t]) ** 2 // q[t] for t in kept if mine[s][t] and p[s][t] > q[t]}
            for part, values, most in (("pair", apart, len(apart)), ("term", marks, top)):
                ranked = sorted(values, key=lambda i: (-values[i], i.encode()))
                out += [(lang, s, part, i, values[i], k + 1) for k, i in enumerate(ranked[:most])]
    return sorted(out)


def audited(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS).repartition(parts)
    return sorted(tuple(r) for r in sd.divergences(sd.stripes(df), **more).collect())


@pytest.fixture(scope="module")
def rows():
    import random
    random.seed(4)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["straße", "ÄRGER", "日本", "the"]
    out = [(" ".join(random.choices(vocabulary, [1 + (hash_ + i) % 7 for i in range(len(vocabulary))], k=random.randint(0, 60))),
            random.choice(["en", "de", None]), f"s{hash_ % 4}") for hash_ in range(150)]
    out += [("the The THE the", "en", "hot")] * 60  # one source with one text over and over
    return out


def test_brute_force(spark, rows):
    assert audited(spark, rows) == brute(rows)


def test_spills_and_small_steps(spark, rows, monkeypatch):
    monkeypatch.setattr(sd, "CELLS", 3)
    monkeypatch.setattr(sd, "SPILL_ENTRIES", 5)
    folded = list(sd._fold(iter([])))
    assert sum(b.num_rows for b in folded) == 0
    here = sd.Sources(("en", 0), 2)
    for name in ("a", "b"):
        here.group(name, 6, 3, 12)
    got = [b for term, counts in ((b"x", [4, 0]), (b"y", [1, 3]), (b"z", [1, 3]))
           for b in here.stripe(term, ["a", "b"], counts)] + list(here.close())
    flat = [r for b in got for r in b.to_pylist()]
    texts = [("x x x x", "en", "a"), ("y z", "en", "a"), ("y z", "en", "b"), ("y z", "en", "b"), ("y z", "en", "b"), ("x", "fr", "q")]
    pairs = {(r["source"], r["other"]): r["value"] for r in flat if r["other"]}
    p = {s: [1 + 10 ** 9 * (c + 1) // 9 for c in n] for s, n in (("a", [4, 1, 1]), ("b", [0, 3, 3]))}
    assert pairs == {(s, o): sum((x - y) ** 2 // y for x, y in zip(p[s], p[o])) for s in "ab" for o in "ab" if s != o}
    assert audited(spark, texts) == brute(texts)


def test_odd_rows(spark):
    odd = [(None, None, None), ("", "en", "a"), (None, "en", "b"), ("12 34 ---", "en", "c"), ("a b", "en", "a"), ("A", "en", "a"),
           ("a", "en", "b"), ("x" * 50_000 + " a", "en", "b"), ("only once", "xx", "lone")]
    assert audited(spark, odd) == brute(odd)
    assert audited(spark, []) == []


def test_top_and_ties(spark):
    tied = [("aa bb cc dd ee ff", "en", "s1")] * 3 + [("zz", "en", "s2")] * 9
    got = [r for r in audited(spark, tied, top=2) if r[2] == "term"]
    assert got == [r for r in brute(tied, top=2) if r[2] == "term"] and [r[3] for r in got if r[1] == "s1"] == ["aa", "bb"]


def test_long_texts_in_chunks(monkeypatch):
    monkeypatch.setattr(sd, "CHUNK_BYTES", 7)
    for text in ("one two three four", "a" * 40 + " b", "", "x", "été Été " * 5, "a b " * 3 + "c" * 30):
        assert [w for part in sd.terms(text.encode()) for w in part] == [w.encode() for w in WORDS.findall(text.translate(LOWER))]


def test_share_is_exact():
    import numpy as np
    counts, whole = np.array([0, 1, 2, 10 ** 12, 10 ** 14 - 1]), 10 ** 14 + 7
    assert sd.share(counts, whole).tolist() == [1 + 10 ** 9 * (int(c) + 1) // whole for c in counts]
    assert sd.share(np.array([4]), 5).tolist() == [10 ** 9 + 1]
