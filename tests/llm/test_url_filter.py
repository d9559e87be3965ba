import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from matchlake.llm import url_filter as uf

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("score", T.StringType())])


def split(url):
    """Host and path as the contract says."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def rule(host, path):
    fits = [(at + below, said) for said, at, below in uf.RULES if (host == at or host.endswith("." + at)) and path.startswith(below)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def coded(url):
    return "".join(chr(c) if 32 < c < 127 else f"%{c:02X}" for c in url.encode())


class Model:
    """The same smoothing, written down once more for single characters and dictionaries."""

    def __init__(self, urls):
        self.follow = defaultdict(Counter)
        for u in urls:
            s = chr(uf.START) * (uf.ORDER - 1) + coded(u) + chr(uf.END)
            for i in range(uf.ORDER - 1, len(s)):
                for k in range(uf.ORDER):
                    self.follow[s[i - k:i]][s[i]] += 1

    def p(self, context, c):
        lower = 1 / uf.ALPHABET if not context else self.p(context[1:], c)
        found = self.follow.get(context)
        return lower if not found else (found[c] + len(found) * lower) / (sum(found.values()) + len(found))

    def log(self, url):
        s = chr(uf.START) * (uf.ORDER - 1) + coded(url) + chr(uf.END)
        return sum(math.log(self.p(s[i - uf.ORDER + 1:i], s[i])) for i in range(uf.ORDER - 1, len(s))) / (len(s) - uf.ORDER + 1)


def judged(spark, rows, parts=3):
    return uf.judge(spark.createDataFrame([(*r, "x") for r in rows], PAGES).repartition(parts)).collect()


@pytest.fixture(scope="module")
def pages():
    out = []
    for i in range(240):
        out.append((i, [f"https://news{i % 7}.example.net/en/story-{i}", f"http://win{i % 5}-casino.net/bonus?id={i}", f"https://a{i % 9}.org/fr/page{i}.html",
                        f"https://shop.example.com/de/sale{i}", f"https://win{i % 5}-casino.info/bonus{i}", f"https://news{i % 7}.site.info/story-{i}#top"][i % 6]))
    return out


def test_scores_and_threshold(spark, pages):
    rows = pages + [(900, pages[1][1]), (900, pages[4][1]), (None, pages[5][1]), (901, "https://münchen.example.info/größe ä"), (902, "x" * 3000)]
    taught = [(u, rule(*split(u))[1]) for _, u in rows]
    models = {v: Model([u for u, said in taught if said == v and zlib.crc32(u.encode()) % uf.FOLDS]) for v in ("allow", "block")}
    got = judged(spark, rows)
    assert sorted(str((r.page_id, r.host, r.path, r.rule)) for r in got) == sorted(str((i, *split(u), rule(*split(u))[0])) for i, u in rows)
    want = sorted(round(models["allow"].log(u) - models["block"].log(u), 9) for _, u in rows)
    assert sorted(round(r.score, 9) for r in got) == pytest.approx(want, abs=1e-8)
    said = {r.page_id: r.verdict for r in got}
    assert all(said[i] == rule(*split(u))[1] for i, u in pages if rule(*split(u))[1])
    assert {said[i] for i, u in pages if "casino.info" in u} == {"block"}
    assert {said[i] for i, u in pages if "site.info" in u} == {"allow"}


def test_hosts_paths_and_longest_rule(spark):
    urls = ["https://EXAMPLE.net/en/a?x#y", "http://sub.Example.NET/en", "ftp://net/", "net/", "http://notexample.com/de/", "http://x.example.com/de/#a?b",
            "http://org/fr/x", "http://org?/fr/", "http://a.b.org#/fr/", "https://h", "a://b://c/d", "://", "http:///en/", "http://x.net:80/en/"]
    got = {r.page_id: r for r in judged(spark, list(enumerate(urls)))}
    for i, u in enumerate(urls):
        host, path = split(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule(host, path)[0]), u
        assert got[i].verdict == (rule(host, path)[1] or "allow")


def test_odd_rows(spark):
    assert judged(spark, []) == []
    got = judged(spark, [(1, None), (2, ""), (3, "\x01\x02\x03"), (None, None), (1, None)])
    assert len(got) == 5 and {r.verdict for r in got} == {"allow"} and {(r.host, r.path, r.rule) for r in got} == {("", "", None)}
    assert sorted(r.score is None for r in got) == [False, True, True, True, True]


def test_packets_are_bounded(spark, pages, monkeypatch):
    df = spark.createDataFrame([(*r, "x") for r in pages], PAGES).coalesce(1)
    monkeypatch.setattr(uf, "PACKET_BYTES", 600)
    rows = uf.packets(df).collect()
    assert sorted(i for r in rows for i in r.ids) == sorted(i for i, _ in pages) and len({r.packet for r in rows}) == len(rows) > 10
    assert all(sum(len(u) + 8 for u in r.urls) <= 600 or len(r.urls) == 1 for r in rows)
