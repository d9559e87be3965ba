import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from matchlake.llm import packing, token_matrix, tokens

VOCABULARY = open(tokens.default_vocabulary(), encoding="utf-8").read()
ALPHABET = list("abcXYZ éÉüßİΣσς'’.,,;:!?-0123½ \t\n\x0b\x0c\x1c\x85  한国̈") + ["'s", "'RE", "<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(VOCABULARY)


def ids_of(words, texts):
    ids, bounds = words.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


KEPT = tokens.WordIds(VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join), max_size=4))
def test_ids_equal_the_tokenizer(texts):
    assert KEPT.by_words
    assert ids_of(KEPT, texts) == [KEPT.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("words, size", [(3, 1 << 20), (1000, 100)])
def test_generations(monkeypatch, words, size):
    """What is remembered may go at any time; ids stay the same."""
    monkeypatch.setattr(tokens, "MEMO_WORDS", words)
    monkeypatch.setattr(tokens, "MEMO_BYTES", size)
    kept = tokens.WordIds(VOCABULARY)
    random.seed(5)
    for _ in range(60):
        text = " ".join(random.choice(["a", "b", "can't", "end.", "end", "x,", "été", "12ab%%%", "new" + str(random.randint(0, 9))]) for _ in range(9))
        assert ids_of(kept, [text, None]) == [kept.tokenizer.encode(text, add_special_tokens=False).ids, []]
    with tokens.encoder(VOCABULARY) as given:
        assert ids_of(given, ["some words"])
    assert not given.words and not given.ids.used


def test_slices_of_columns():
    column = pa.array(["one two", None, "three <|endoftext|> four", "", "five"], pa.string())
    ids, bounds = KEPT.encode(column.slice(1, 3))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [
        KEPT.tokenizer.encode(t, add_special_tokens=False).ids for t in ("", "three <|endoftext|> four", "")]
    assert tokens.sizes(column).tolist() == [7, 0, 24, 0, 4]


def test_other_tokenizers_get_whole_texts():
    """A tokenizer that keeps case and white space is never asked for words."""
    import public_tokenizers
    other = tokens.WordIds(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    texts = ["Two  Words here.", "", "tab\tand\nline", "x" * 300]
    assert not other.by_words and ids_of(other, texts) == [other.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def places(histogram, capacity, **options):
    """Places of all pieces of a histogram, found the way the tasks find them."""
    found = packing.plan(histogram, capacity, **options)
    runs = np.array(sorted(found.rows), dtype=np.int64).reshape(-1, 5)
    key = (runs[:, 0] << 48) | runs[:, 1]
    out = []
    for n, count in histogram.items():
        for rank in range(count):
            run = runs[np.searchsorted(key, (n << 48) | rank, side="right") - 1]
            assert run[0] == n
            out.append((int(run[2] + (rank - run[1]) // run[3]), int(run[4] + (rank - run[1]) % run[3] * n), n))
    return out, found.sequences


def assert_packed(rows, capacity):
    at = {}
    for sequence, offset, n in sorted(rows):
        assert at.get(sequence, 0) == offset
        at[sequence] = offset + n
        assert at[sequence] <= capacity
    return len(at)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=20), st.integers(1, 6))
def test_plans_are_gapless(histogram, groups):
    rows, n = places(histogram, 60, groups=groups)
    assert assert_packed(rows, 60) == n
    total = sum(k * v for k, v in histogram.items())
    assert n >= -(-total // 60)


def test_plans_are_tight():
    rng = random.Random(2)
    for capacity, draw in ((4096, lambda: min(4096, int(rng.lognormvariate(6.2, 1.1)) + 1)), (1000, lambda: rng.randint(1, 1000)),
                           (1000, lambda: rng.choice([334, 333, 500, 251, 20]))):
        histogram = {}
        for _ in range(4000):
            n = draw()
            histogram[n] = histogram.get(n, 0) + 1
        rows, n = places(histogram, capacity)
        assert assert_packed(rows, capacity) == n
        bfd = packing.Plan(capacity)
        for length, count in sorted(histogram.items(), reverse=True):
            bfd.best_fit(length, 0, count)
        bound = -(-sum(k * v for k, v in histogram.items()) // capacity)
        assert n <= max(bfd.sequences, bound) * 1.03 + 2


def test_configurations_solve_the_relaxed_problem():
    taken = packing.configurations(np.array([50, 30, 20]), np.array([10.0, 10.0, 10.0]), 100)
    assert sum(times for _, times in taken) <= 10 and all((column * [50, 30, 20]).sum() <= 100 for column, _ in taken)
    assert (sum(column * times for column, times in taken) <= [10, 10, 10]).all()


def expected(tokenizer, rows, capacity):
    out = []
    for key, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        out += [(key, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
                for k, s in enumerate(range(0, len(ids), capacity))]
    return sorted(out, key=str)


ROWS = [(1, None), (2, ""), (3, "Some words, here. And there."), (3, "Some words, here. And there."), (4, "one two " * 700), (None, "x y z"), (5, "<|endoftext|> A.")]


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pack_documents(make_docs, tokenizer, capacity):
    docs = make_docs([t for _, t in ROWS], [k for k, _ in ROWS]).withColumn("piece", F.lit("clash")).withColumn("offset", F.lit(1))
    got = packing.pack(tokens.pieces(docs, capacity=capacity), capacity=capacity).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == expected(tokenizer, ROWS, capacity)
    assert_packed([(r.sequence_id, r.offset, r.length) for r in got], capacity)


def test_pack_odd_tables(spark, make_docs):
    assert packing.pack(tokens.pieces(make_docs([]))).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0)], "k int, length int"))
    hot = spark.range(3000).select(F.lit(700).alias("length"))
    assert packing.pack(hot).agg(F.countDistinct("sequence_id")).first()[0] == 600


def test_segment_tree_finds_the_least_room():
    rng = random.Random(4)
    tree, held = token_matrix.RoomTree(50), []
    for k in range(3000):
        if rng.random() < 0.55:
            room = rng.randint(1, 50)
            tree.add(room, k)
            held.append(room)
        else:
            n = rng.randint(1, 50)
            fit = [r for r in held if r >= n]
            got = tree.take(n)
            assert (got[0] if got else None) == (min(fit) if fit else None)
            if got:
                held.remove(got[0])


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_matrix_round_trip(make_docs, tokenizer, id_bytes):
    docs = make_docs([t for _, t in ROWS], [k for k, _ in ROWS]).withColumn("ids", F.lit("clash"))
    matrix = token_matrix.pack_matrices(docs, capacity=64, id_bytes=id_bytes)
    for r in matrix.collect():
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids == len(r.ids) // id_bytes <= 64
        assert r.position_resets == r.cu_seqlens[:-1] == [s.offset for s in r.segments]
    got = token_matrix.segments_of(matrix, id_bytes=id_bytes).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == expected(tokenizer, ROWS, 64)
    assert_packed([(r.sequence_id, r.offset, r.length) for r in got], 64)
    assert token_matrix.pack_matrices(make_docs([])).count() == 0
