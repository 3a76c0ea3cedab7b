import itertools
import random
from pathlib import Path

import numpy as np
import pytest

from bitloom.llm import packing, tokenizer

pytestmark = pytest.mark.skipif(not Path(tokenizer.VOCABULARY).exists(), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def codec():
    return tokenizer.Codec(Path(tokenizer.VOCABULARY).read_bytes())


def texts():
    rng = random.Random(2)
    signs = [chr(rng.randrange(32, 0x3100)) for _ in range(60)] + list(" \n\t\r\x00\x85\xa0'abcdefgABC0129=-_") + ["'s", "'ll", "<|endoftext|>", "🌊", "\U0010ffff"]
    out = ["".join(rng.choice(signs) for _ in range(rng.randrange(80))) for _ in range(400)]
    return out + ["a" * 20_000, "=" * 9000, " " * 9000 + "x", "的" * 3000, "ab" * 9000, "<|endoftext|>"]


def test_ids_are_those_of_the_public_library(codec, reference):
    for s in texts():
        ids = codec.encode(s).tolist()
        assert ids == reference(s)
        assert codec.decode(ids) == s


def test_pair_table_is_merging_itself(codec):
    def merged(data):
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((codec.rank.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [codec.rank[x] for x in parts]

    rng = random.Random(4)
    short = [i for i, t in enumerate(codec.tokens) if len(t) <= 4]
    for _ in range(3000):
        a, b = rng.choice(short), rng.choice(short)
        assert codec.may_follow(a, b) == (merged(codec.tokens[a] + codec.tokens[b]) == [a, b])


def test_documents(spark, reference):
    rows = [(i, s, "x") for i, s in enumerate(texts())] + [(900, None, "x"), (901, "", "x"), (None, "ab", "x"), (5, texts()[5], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = tokenizer.encode_documents(docs)
    assert got.columns == ["doc_id", "ids"]
    kept = [(r.doc_id, list(r.ids)) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(i, reference(s) if s else []) for i, s, _ in rows], key=str)
    back = {r.doc_id: r.text for r in tokenizer.decode_documents(got).collect()}
    assert all(back[i] == (s or "") for i, s, _ in rows)
    counts = {r.doc_id: r.n_tokens for r in tokenizer.count_tokens(docs).collect()}
    assert counts[900] == counts[901] == 0 and counts[3] == len(reference(rows[3][1]))
    assert tokenizer.encode_documents(docs.limit(0)).count() == 0


def check(rows, capacity):
    load = {}
    for r in rows:
        load[r.container] = load.get(r.container, 0) + r.n_tokens
    assert max(load.values(), default=0) <= capacity
    return load


def test_containers(spark):
    rng = np.random.default_rng(0)
    sizes = [int(s) for s in np.concatenate([rng.geometric(0.02, 3000), rng.integers(1, 100, 500), [0, 0, 0, 100, 101, 250, 1000]])]
    rows = [(i, s, "x") for i, s in enumerate(sizes)] + [(7000, None, "x"), (None, 5, "x"), (1, sizes[1], "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, container string").repartition(5)
    got = packing.fill_containers(df, 100).collect()
    load = check(got, 100)
    total = sum(s or 0 for _, s, _ in rows)
    assert sum(load.values()) == total and len(load) <= -(-total // 100) + 1
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, s in enumerate(sizes):
        if i != 1:
            pieces = sorted(by[i], key=lambda r: r.piece)
            assert [r.start for r in pieces] == list(range(0, max(s, 1), 100)) and sum(r.n_tokens for r in pieces) == s
            assert len(pieces) == max(1, -(-s // 100))
    assert len(by[None]) == len(by[7000]) == 1 and sum(r.n_tokens for r in by[1]) == 2 * sizes[1]
    again = packing.fill_containers(df.coalesce(1), 100).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_containers_of_nothing(spark):
    df = spark.createDataFrame([(1, 0)], "doc_id bigint, n_tokens bigint")
    assert [tuple(r) for r in packing.fill_containers(df).collect()] == [(1, 0, 0, 0, 0)]
    assert packing.fill_containers(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_item_once_and_wastes_little(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(65, np.int64)
    counts[1:] = rng.poisson(rng.choice([0.3, 3, 30]), 64)
    plan = packing.container_plan(counts, 64)
    used = np.zeros(65, np.int64)
    for need, times in plan:
        assert sum(k * n for k, n in need.items()) <= 64
        for k, n in need.items():
            used[k] += n * times
    assert np.array_equal(used, counts) and len(plan) <= sum(1 + np.log2(c) for c in counts if c)
    slots = packing.slots_of(plan)
    assert (slots[:, 3] > 0).all() and slots.tolist() == sorted(slots.tolist())
    total = int((np.arange(65) * counts).sum())
    assert sum(t for _, t in plan) <= 1.02 * max(-(-total // 64), int(counts[33:].sum())) + 2


def test_plentiful_lengths_and_the_index_of_sums():
    counts = np.r_[0, np.full(256, 10**9)]
    assert sum(t for _, t in packing.container_plan(counts, 256)) == -(-int((np.arange(257) * counts).sum()) // 256)
    rng = np.random.default_rng(5)
    for _ in range(20):
        left = np.zeros(61, np.int64)
        left[1:] = rng.integers(0, 3, 60) * (rng.random(60) < 0.3)
        index = packing._Lengths(left)
        there = [n for n in range(61) for _ in range(left[n])]
        sums = [set(map(sum, itertools.combinations(there, k))) for k in range(4)]
        for total in range(1, 61):
            for parts in (1, 2, 3):
                found = index._parts(total, parts)
                assert (found is not None) == (total in sums[parts])
                assert found is None or sum(found) == total and all(left[n] >= found.count(n) for n in found)


def test_faults_are_told(spark):
    sized = spark.createDataFrame([(1, 60), (2, 50), (3, 200), (4, 10)], "doc_id bigint, n_tokens bigint")
    right = packing.fill_containers(sized, 100)
    assert packing.fill_faults(right, sized, 100).drop("items", "spare").first()[:] == (0, 0, 0, 0, 0)
    rows = [(1, 0, 0, 30, 0), (1, 1, 30, 30, 1), (2, 0, 0, 50, 0), (2, 0, 0, 50, 0), (3, 0, 0, 100, 2), (3, 1, 100, 100, 3)]
    wrong = spark.createDataFrame(rows, "doc_id bigint, piece bigint, start bigint, n_tokens bigint, container bigint")
    got = packing.fill_faults(wrong, sized, 100).first()
    assert (got.items, got.missing, got.twice, got.split, got.wrong_size, got.overfull) == (4, 1, 1, 2, 1, 1)
    with pytest.raises(ValueError):
        packing.fill_containers(sized, 1 << 15)


def test_fill_documents(spark):
    docs = spark.createDataFrame([(i, "word " * n) for i, n in enumerate([3, 5000, 0, 900])], "doc_id bigint, text string")
    filled = packing.fill_with_documents(docs)
    assert check(filled.collect(), 4096) and sum(r.used * r.containers for r in packing.container_fill(filled).collect()) == sum(r.n_tokens for r in filled.collect())
