"""Near duplicates by SimHash fingerprints that are searched in BK-trees.

Two fingerprints within ``MAX_BITS`` bits agree on at least one of ``MAX_BITS + 1`` blocks of bits, so every
distinct fingerprint goes to one shard for each block. A shard with more than ``SHARD`` fingerprints is divided
again by blocks of its other bits; one that stays large is dealt into trees of ``SHARD`` nodes, each sent to
all searches of that shard. A tree's children are keyed by their distance to the parent; a search follows only the
edges within the radius. Shards hand on a spanning forest of their links, never all pairs.

Null texts and texts without words have fingerprint zero and link like any other. Copies share a fingerprint and
so a component. Rows whose id is null get a component from the other rows they reach, null if there are none.
Texts of any length are read whole, empty tables give no rows, and columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.llm.components import components
from duesight.llm.scratch import cut

WORDS = 3
MAX_BITS = 3
SHARD = 2000
#: Shingles counted at a time, which bounds the memory a long text takes.
_CHUNK = 65_536


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is in over half the hashes of the shingles."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) < words:
        return digest(b" ".join(tokens), 42)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    stops, n = ends[words - 1 :].tolist(), len(tokens) - words + 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long) and the text columns ``more`` of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(text, words) for text in batch.text], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch.doc_id, "fp": found.view(np.int64)} | {c: batch[c] for c in more})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    return rows.mapInPandas(run, ", ".join(["doc_id long, fp long", *(f"{c} string" for c in more)]))


class BKTree:
    """Fingerprints with children keyed by integer Hamming distance, and the sets that links have joined."""

    def __init__(self, radius: int):
        self.radius = radius
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []  # of the union-find forest over all codes met
        self.whole: list[int] = []  # a member of the only set below a node, or -1 if there are several

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def near(self, code: int) -> list[int]:
        """Nodes within the radius; below a node whose set has already answered, no more are looked for."""
        found: list[int] = []
        sets: set[int] = set()
        todo = [0] if self.codes else []
        while todo:
            i = todo.pop()
            if sets and self.whole[i] >= 0 and self.find(self.whole[i]) in sets:
                continue
            d = (self.codes[i] ^ code).bit_count()
            if d <= self.radius:
                found.append(i)
                sets.add(self.find(i))
            low, high = d - self.radius, d + self.radius
            todo.extend(child for key, child in self.children[i].items() if low <= key <= high)
        return found

    def insert(self, code: int) -> int:
        """Add a code, joined with all it links to; its number."""
        linked, me = self.near(code), len(self.codes)
        self.codes.append(code)
        self.children.append({})
        self.parent.append(me)
        self.whole.append(me)
        for i in linked:
            self.parent[self.find(i)] = self.find(me)
        at = 0
        while me:
            if self.whole[at] >= 0 and self.find(self.whole[at]) != self.find(me):
                self.whole[at] = -1
            d = (self.codes[at] ^ code).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = me
                break
            at = self.children[at][d]
        return me


def _forest(codes: list[int], members: list[bool], radius: int) -> Iterator[tuple[int, int]]:
    """Links that join what the links between the members, and from the others to the members, join."""
    tree = BKTree(radius)
    for code, member in zip(codes, members, strict=True):
        if member:
            tree.insert(code)
    for i, code in enumerate(tree.codes):
        if (root := tree.find(i)) != i:
            yield code, tree.codes[root]
    for code, member in zip(codes, members, strict=True):
        if not member:
            for root in {tree.find(i) for i in tree.near(code)}:
                yield code, tree.codes[root]


def _search(radius: int):
    """For rows sorted by shard: the links of each shard. A shard may run over several batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(rest: pd.DataFrame, last: bool):
            keys = rest[["block", "sub", "part"]].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(rest)]
            codes, members = rest.fp.to_numpy().view(np.uint64).tolist(), rest.member.to_numpy().tolist()
            stop = len(cuts) - 1 - (not last)
            out = [x for a, b in zip(cuts[:stop], cuts[1 : stop + 1], strict=True) if b - a > 1 for x in _forest(codes[a:b], members[a:b], radius)]
            found = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"u": found[:, 0], "v": found[:, 1]}), rest.iloc[cuts[stop] :]

        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(rest):
                found, rest = links(rest, False)
                yield found
        if rest is not None and len(rest):
            yield links(rest, True)[0]

    return run


def _divided(rows: DataFrame, keys: list[str], shard: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the shards with at most ``shard`` rows, and of the others with their number ``n``."""
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard)
    marked = cut(rows.join(large, keys, "left"), "shards")
    return marked.filter("n is null").drop("n"), marked.filter("n is not null")


def near_links(codes: DataFrame, bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """``u, v``: links that connect exactly the distinct fingerprints ``fp`` that are linked within ``bits`` bits."""
    n, width = bits + 1, 64 // (bits + 1)
    # the last block takes the bits that are left over
    block = lambda k: F.shiftrightunsigned("fp", k * width) if k == n - 1 else F.shiftrightunsigned("fp", k * width).bitwiseAND((1 << width) - 1)
    blocks = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), block(k).alias("value")) for k in range(n)]))
    rows = codes.select("fp", blocks.alias("b")).select("fp", "b.k", F.xxhash64("b.k", "b.value").alias("block"))
    light, heavy = _divided(rows, ["block"], shard)

    # The other bits of a large shard, in blocks as well.
    fine = max(1, (64 - width) // n)
    where = [[i for i in range(64) if not (k * width <= i < ((k + 1) * width if k < n - 1 else 64))] for k in range(n)]
    subs = []
    for k in range(n):
        own = where[k]
        masks = [sum(1 << i for i in (own[j * fine : (j + 1) * fine] if j < n - 1 else own[j * fine :])) for j in range(n)]
        subs.append(F.array(*[F.xxhash64(F.lit(j), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for j, m in enumerate(masks)]))
    pick = subs[-1]
    for k in range(n - 1):
        pick = F.when(F.col("k") == k, subs[k]).otherwise(pick)
    finer = heavy.drop("n").withColumn("sub", F.explode(pick))
    small, large = _divided(finer, ["block", "sub"], shard)
    parts = F.ceil(F.col("n") / shard).cast("long")
    dealt = large.withColumn("home", F.pmod(F.xxhash64(F.lit("part"), "fp"), parts)).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    every = (
        light.select("fp", "block", F.lit(0).cast("long").alias("sub"), F.lit(0).cast("long").alias("part"), F.lit(True).alias("member"))
        .unionByName(small.select("fp", "block", "sub", F.lit(0).cast("long").alias("part"), F.lit(True).alias("member")))
        .unionByName(dealt.select("fp", "block", "sub", "part", (F.col("home") == F.col("part")).alias("member")))
    )
    shards = every.repartition("block", "sub", "part").sortWithinPartitions("block", "sub", "part", "fp")
    return shards.mapInPandas(_search(bits), "u long, v long")


def _labelled(docs: DataFrame, words: int, bits: int, shard: int, id_col: str, text_col: str, more: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp``, the columns ``more``, ``root`` (one fingerprint for each component) and ``component_id``."""
    rows = cut(fingerprints(docs, words, id_col, text_col, more), "fingerprints")
    codes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "codes")
    roots = components(near_links(codes.select("fp"), bits, shard))
    rooted = codes.join(roots, codes.fp == roots.node, "left").select("fp", "low_id", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    labels = cut(rooted.join(lowest, "root").select("fp", "root", "component_id"), "labels")
    return rows.join(labels, "fp")


def representatives(docs: DataFrame, key_col: str, words: int = WORDS, bits: int = MAX_BITS, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``key_col`` of one row of each component: the smallest id, null last, then the smallest key."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key_col))
    rows = _labelled(docs, words, bits, shard, id_col, text_col, (key_col,))
    return rows.groupBy("root").agg(first.alias("one")).select("one.doc_id", f"one.{key_col}")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = MAX_BITS, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest id that links reach, of every row."""
    rows = _labelled(docs, words, bits, shard, id_col, text_col)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
