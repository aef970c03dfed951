"""Operators across documents, against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from harbor.llm import decontaminate, golay, near_dedup
from harbor.llm.components import components
from harbor.llm.simhash import fingerprint_texts
from tests.llm.frames import ALL_IDS, PROSE, ROWS, documents, ids_of, items

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint_by_hand(text):
    lowered = (text or "").encode()
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in lowered)
    words = WORD.findall(lowered)
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = [t for _, t in ROWS if t is None or len(t) < 1000] + ["A b\tC", "É É é", "x " * 9, "a\x1cb c d", "a b", "a b c d"]
    got = fingerprint_texts([(t or "").encode() for t in texts], 3)
    assert got.tolist() == [fingerprint_by_hand(t) for t in texts]


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000).astype(np.uint32)
    for bits in range(3):
        other = words.copy()
        for i in range(len(other)):
            for b in rng.choice(23, bits, replace=False):
                other[i] ^= np.uint32(1 << int(b))
        row, key = golay.keys(words)
        both = set(zip(row.tolist(), key.tolist())) & set(zip(*(x.tolist() for x in golay.keys(other))))
        assert {r for r, _ in both} == set(range(len(words)))
        assert set(Counter(row.tolist()).values()) == {1, 6}


def components_by_hand(prints):
    """Smallest id of each fingerprint's component, by all pairs."""
    distinct = sorted(set(prints.values()))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(distinct):
        for q in distinct[:i]:
            if (p ^ q).bit_count() <= 2:
                root[find(p)] = find(q)
    least = {}
    for i, p in prints.items():
        least[find(p)] = min(i, least.get(find(p), i))
    return {i: least[find(p)] for i, p in prints.items()}


@pytest.mark.parametrize("paired", [64, 2])
def test_links_of_dense_fingerprints(spark, paired):
    """A dense cloud, chains, and pairs at two and three bits, by pairs or through neighbours."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    prints = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(150)]
    chain = rng.getrandbits(64)
    for _ in range(60):
        chain ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])))
        prints.append(chain)
    prints += [rng.getrandbits(64) for _ in range(50)] + [0, 1 << 63, 3 << 62, (1 << 64) - 1]
    by_id = dict(enumerate(dict.fromkeys(prints)))
    signed = {i: p - (1 << 64) if p >> 63 else p for i, p in by_id.items()}
    nodes = spark.createDataFrame([(p,) for p in signed.values()], "fp long")
    found = near_dedup.links(nodes, paired).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in found)
    roots = {r.node: r.root for r in components(near_dedup.links(nodes, paired), "a", "b").collect()}
    groups = {}
    for i, p in signed.items():
        groups.setdefault(roots.get(p, p), []).append(i)
    got = {i: min(g) for g in groups.values() for i in g}
    assert got == components_by_hand(by_id)


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(3)
    path = list(range(100))
    rng.shuffle(path)
    edges = list(zip(path, path[1:])) + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (6, 7), (7, 6)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(frame, "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 100)} | {i: 1000 for i in range(1001, 1100)}
    assert components(frame.limit(0), "a", "b").count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    rows = [*ROWS, (20, "a b c"), (21, "A  B\tC"), (22, "a b d")]
    docs = documents(spark, rows)
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    prints = {i: fingerprint_by_hand(t) for i, t in rows if i is not None}
    want = components_by_hand(prints)
    for r in found:
        if r.doc_id is not None:
            assert (r.fp % (1 << 64), r.component_id) == (prints[r.doc_id], want[r.doc_id])
    # The rows without an id: one has words of its own, the other none.
    assert Counter(r.component_id for r in found if r.doc_id is None)[1] == 1
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert ids_of(kept) == [*sorted(set(want.values())), None, None]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == near_dedup.keep_one(docs.limit(0)).count() == 0


def similarity_by_hand(one, two):
    size = min(5, len(two))
    left = Counter(tuple(one[i : i + size]) for i in range(len(one) - size + 1))
    right = Counter(tuple(two[i : i + size]) for i in range(len(two) - size + 1))
    total = sum(left.values()) + sum(right.values())
    return 2 * sum((left & right).values()) / total if total else 0.0


def leaks_by_hand(docs, benchmark):
    found = {}
    for doc, text in docs:
        words = [w.decode() for w in WORD.findall((text or "").lower().encode())]
        for item, said in benchmark:
            own = [w.decode() for w in WORD.findall((said or "").lower().encode())]
            for start in range(max(1, len(words) - len(own) + 1)) if own and words else ():
                s = similarity_by_hand(words[start : start + len(own)], own)
                if s >= 0.8 and s > found.get((doc, item), (0, 0))[0]:
                    found[doc, item] = (s, start)
    return found


def test_leaks_against_all_windows(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    benchmark = [(i, " ".join(rng.choices(words, k=rng.randrange(12, 60)))) for i in range(12)]
    benchmark += [(50, "Two words"), (51, "tiny"), (52, ""), (53, None), (54, "a b c d"), (55, benchmark[0][1])]
    docs = [*[(i, t) for i, t in ROWS if t is None or len(t) < 1000 and i is not None], (99, "TINY"), (98, "x two  WORDS y a b c d")]
    for i in range(100, 180):
        own = rng.choices(words, k=rng.randrange(80))
        passage = rng.choice(benchmark[:12])[1].split()
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            passage[rng.randrange(len(passage))] = "changed"
        cut = rng.choice([0, 0, 1, 3])
        docs.append((i, " ".join([*own[:40], *passage[cut:], *own[40:]]).upper()))
    want = leaks_by_hand(docs, benchmark)
    rows = decontaminate.leaks(
        documents(spark, docs), items(spark, [(*b, "clash") for b in benchmark])
    ).collect()
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in rows}
    assert len(got) == len(rows) and set(got) <= set(want)
    assert {k: v for k, v in got.items() if want[k] != v} == {}
    # Beyond the radius a similar window may be passed over; nearly none is.
    assert len(got) >= 0.97 * len(want) and len(want) > 60
    assert {k for k, (s, _) in want.items() if s == 1.0} <= set(got)


def test_no_leak_is_lost_for_its_fingerprint(spark):
    """Passages just similar enough, at the edges of documents, within them and as short documents."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)] + ["the", "of"] * 400
    benchmark = [(i, " ".join(rng.choices(words, k=k))) for i, k in enumerate([5, 8, 12, 15, 20, 30, 30, 40, 60, 90])]
    benchmark += [(20, "a b " * 12), (21, "a b c d a b c d e f g a b c d")]
    docs = []
    for i in range(240):
        passage = rng.choice(benchmark)[1].split()
        gone = round(len(passage) * rng.choice([0.05, 0.1, 0.15, 0.2, 0.3, 0.33]))
        passage = passage[gone:] if rng.random() < 0.5 else passage[: len(passage) - gone]
        own = rng.choices(words, k=rng.choice([0, 0, 10, 40]))
        docs.append((i, " ".join([*passage, *own] if i % 2 else [*own, *passage])))
    want = leaks_by_hand(docs, benchmark)
    found = decontaminate.leaks(documents(spark, docs), items(spark, [(*b, "clash") for b in benchmark])).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.start) for r in found} == want
    assert any(r.distance > decontaminate.RADIUS for r in found)


def test_blocks_find_all_fingerprints_within_the_radius():
    rng = random.Random(5)
    variants = set(decontaminate._variants(decontaminate.RADIUS))
    for _ in range(500):
        difference = sum(1 << b for b in rng.sample(range(64), decontaminate.RADIUS))
        blocks = [difference >> 16 * i & 0xFFFF for i in range(decontaminate.BLOCKS)]
        assert variants & set(blocks)


def test_leaking_documents_go_and_others_stay(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = documents(spark, [*ROWS, (30, f"so {item} so"), (31, item[:30])])
    bench = items(spark, [(1, item, "c"), (2, None, "c"), (3, "", "c")])
    kept = decontaminate.drop_leaking(docs, bench)
    assert kept.columns == docs.columns
    assert ids_of(kept) == sorted([*ALL_IDS, 31], key=lambda i: (i is None, i))
    assert decontaminate.drop_leaking(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(documents(spark, [(1, PROSE)]), items(spark, [(7, PROSE, "c")])).first().similarity == 1.0
