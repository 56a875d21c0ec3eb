from __future__ import annotations

import random
import re

import xxhash

from duesight.llm import simhash as S
from duesight.llm.components import components
from tests.llm.conftest import texts_of


def plain_fingerprint(text, words=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall("[^ \t-\r]+", lowered)
    grams = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(codes, bits):
    """Smallest position reachable, by comparing all pairs."""
    low = list(range(len(codes)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(codes):
            for j, b in enumerate(codes):
                if (a ^ b).bit_count() <= bits and low[j] != low[i]:
                    low[i] = low[j] = min(low[i], low[j])
                    changed = True
    return low


def brute(rows, words=3, bits=3):
    codes = [plain_fingerprint(t, words) for _, t in rows]
    low = classes(codes, bits)
    out = []
    for (doc_id, _), code, c in zip(rows, codes, low, strict=True):
        ids = [i for (i, _), x in zip(rows, low, strict=True) if x == c and i is not None]
        out.append((doc_id, f"{code:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_equals_brute_force(documents):
    docs = documents.limit(150)
    assert rows_of(S.near_duplicates(docs)) == brute(texts_of(docs))


def test_many_words_with_chunks(documents, monkeypatch):
    monkeypatch.setattr(S, "_CHUNK", 7)
    for _, text in texts_of(documents)[:20]:
        assert S.fingerprint(text) == plain_fingerprint(text)


def test_shards_of_any_size_find_the_same(spark):
    """Clusters of close codes, with shards so small that both finer divisions are used."""
    draw = random.Random(5)
    codes = []
    for _ in range(12):
        seed = draw.getrandbits(64)
        for _ in range(12):
            code = seed
            for _ in range(draw.randint(0, 5)):
                code ^= 1 << draw.randrange(64)
            codes.append(code)
    codes = sorted(set(codes) | {0, (1 << 64) - 1, 7})
    want = classes(codes, 3)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    for shard in (1, 3, 2000):
        roots = {r.node % (1 << 64): r.root % (1 << 64) for r in components(S.near_links(frame, 3, shard)).collect()}
        got = [roots.get(c, c) for c in codes]
        same = {}
        for a, b in zip(got, want, strict=True):
            assert same.setdefault(a, b) == b
        assert len(set(got)) == len(set(want))


def test_the_tree_visits_no_more_than_the_radius_allows():
    draw = random.Random(3)
    codes = list({draw.getrandbits(64) for _ in range(300)})
    tree = S.BKTree(3)
    for c in codes:
        tree.insert(c)
    for c in codes:
        probe = c ^ 0b11
        assert {tree.codes[i] for i in tree.near(probe)} == {x for x in codes if (x ^ probe).bit_count() <= 3}
    for at, kids in enumerate(tree.children):
        assert all((tree.codes[at] ^ tree.codes[k]).bit_count() == d for d, k in kids.items())


def test_other_lengths_and_distances(documents):
    docs = documents.limit(60)
    for bits in (0, 1, 7):
        assert rows_of(S.near_duplicates(docs, words=2, bits=bits, shard=2)) == brute(texts_of(docs), 2, bits)


def test_awkward_rows(awkward, empty):
    assert rows_of(S.near_duplicates(awkward)) == brute(texts_of(awkward))
    assert S.near_duplicates(empty).collect() == []


def test_components_of_a_chain(spark):
    n = 200
    draw = random.Random(1)
    names = draw.sample(range(10**6), n)
    links = spark.createDataFrame([(names[i], names[i + 1]) for i in range(n - 1)], "u long, v long")
    got = components(links).collect()
    assert {r.node for r in got} == set(names) and {r.root for r in got} == {min(names)}
