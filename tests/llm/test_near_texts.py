"""Similar texts against a comparison of all shingle sets that share a shingle."""

from __future__ import annotations

import os
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from harbor.llm import near_texts
from harbor.llm.texts import texts_of
from tests.llm.frames import ALL_IDS, ROWS, documents, ids_of



def shingles(text):
    small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", small)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def pairs_by_hand(sets):
    """Pairs of different sets alike by 0.8, met through every shingle they share."""
    holders, found = defaultdict(list), set()
    for n, one in enumerate(sets):
        shared = defaultdict(int)
        for shingle in one:
            for m in holders[shingle]:
                shared[m] += 1
            holders[shingle].append(n)
        for m, both in shared.items():
            if 5 * both >= 4 * (len(one) + len(sets[m]) - both):
                found.add((m, n))
    return found


def components_by_hand(rows):
    """The smallest id that similar texts lead to, by id."""
    nodes = defaultdict(list)
    for i, text in rows:
        nodes[shingles(text)].append(i)
    sets = list(nodes)
    root = list(range(len(sets)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs_by_hand(sets):
        root[find(a)] = find(b)
    members = defaultdict(list)
    for n, one in enumerate(sets):
        members[find(n)] += nodes[one]
    return {i: min(ids) for ids in members.values() for i in ids}


def edited(made, words, n):
    words = list(words)
    for _ in range(n):
        at = made.randrange(len(words))
        words[at : at + made.choice([0, 1, 2])] = [f"new{made.randrange(10**6)}"] * made.choice([0, 1])
    return words


def near_copies(n_groups=60, size=6):
    """Groups of texts with a few words changed, from hardly to just beyond similar."""
    made, rows = random.Random(2), []
    for _ in range(n_groups):
        words = [f"w{made.randrange(5000)}" for _ in range(made.choice([30, 60, 120, 300, 900]))]
        rows.append(" ".join(words))
        for _ in range(size - 1):
            changed = edited(made, words, made.randint(0, max(1, len(words) // 40)))
            rows.append(" ".join(changed).upper() if made.random() < 0.2 else " ".join(changed))
    return list(enumerate(rows))


def agreement(spark, rows, **options):
    want = components_by_hand(rows)
    got = {r.doc_id: r.component_id for r in near_texts.near_duplicates(documents(spark, rows), **options).collect()}
    linked = [i for i in want if want[i] != i]
    assert got.keys() == want.keys() and len(linked) > 20
    # Whatever is linked is linked by hand as well.
    first = defaultdict(set)
    for i, c in got.items():
        first[c].add(want[i])
    assert all(len(components) == 1 for components in first.values())
    return sum(got[i] == want[i] for i in linked) / len(linked)


def test_near_copies(spark):
    rows = near_copies()
    sets = [shingles(t) for _, t in rows]
    assert len(pairs_by_hand(list(dict.fromkeys(sets)))) > 150
    assert agreement(spark, rows) > 0.98


@pytest.mark.parametrize("paired, least", [(2, 0.95), (16, 0.98)])
def test_large_groups(spark, paired, least):
    """More near copies of one text than are compared pair by pair."""
    assert agreement(spark, near_copies(2, 150), paired=paired) > least


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the test tables")
def test_recall_over_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    want = components_by_hand(rows)
    got = {r.doc_id: r.component_id for r in near_texts.near_duplicates(table).collect()}
    assert got == want


def test_shingle_sets():
    texts = ["", None, "a", "A b", "a b c d e f", "x x x x x x x", "a b c d e"]
    hashes, first = near_texts.shingle_sets(texts_of(pa.array(texts)))
    found = [hashes[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    assert [len(f) for f in found] == [len(shingles(t)) for t in texts]
    assert set(found[6]) < set(found[4]) and len({*map(tuple, found)}) == 6


def test_one_of_each_stays(spark):
    docs = documents(spark)
    kept = near_texts.keep_one(docs)
    assert kept.columns == docs.columns
    ids = ids_of(kept)
    want = components_by_hand([r for r in ROWS if r[0] is not None])
    assert [i for i in ids if i is not None] == sorted(set(want.values()))
    assert ids.count(None) == ALL_IDS.count(None)
    assert near_texts.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("paired", [2, 16])
def test_large_groups_lose_no_link(spark, paired):
    """Texts alike that are neither smallest nor largest of any band they share."""
    assert agreement(spark, near_copies(2, 150), paired=paired) == 1


def test_the_rest_is_found_in_blocks(spark):
    """All pairs that are alike, of any two roots, whatever the blocks hold."""
    rows = near_copies(6, 20)
    sets = [shingles(t) for _, t in rows]
    texts = spark.createDataFrame(rows, "node long, text string")
    apart = spark.createDataFrame([(i, i % 3) for i, _ in rows], "node long, root long")
    want = {p for p in pairs_by_hand(sets) if p[0] % 3 != p[1] % 3}
    for block in (1, 7, 1000):
        early = near_texts._early(apart, texts)
        got = near_texts._rest(apart, early, block).distinct().collect()
        assert want <= {(min(p), max(p)) for p in got}
        assert all(u % 3 != v % 3 for u, v in got)
