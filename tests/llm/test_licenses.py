"""License scans against SQL and against a plain reading of the rules."""

from __future__ import annotations

import random
import re
import time

import duckdb
import pandas as pd
import pytest

from harbor.llm import licenses, queries
from harbor.llm.expected import SQL
from harbor.llm.license_rules import KINDS, SIGNATURES, Signature
from tests.llm.frames import ALL_IDS, LONG, documents, ids_of


def scanned(spark, texts, signatures=SIGNATURES):
    docs = documents(spark, list(enumerate(texts)))
    found = licenses.find_licenses(docs, signatures).collect()
    assert len(found) == len(texts)
    return {r.doc_id: r for r in found}


def said(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def detections(words, signatures):
    """Every place of every rule, then what nothing suppresses, two by two."""
    spoken = " " + "  ".join(words) + " " if words else ""
    found = []
    for turn, s in enumerate(signatures):
        if s.keyword in spoken:
            for m in re.finditer(f" ({licenses.spread(s.pattern)}) ", spoken):
                start = spoken[: m.start() + 1].count("  ")
                found.append((start, start + len(m[1].split()), KINDS.index(s.kind), turn, s.label))

    def suppressed(d):
        for o in found:
            if o[2] < d[2] and o[0] < d[1] and d[0] < o[1]:
                return True
            if o[2] == d[2] and o != d and o[0] <= d[0] and o[1] >= d[1]:
                if o[1] - o[0] > d[1] - d[0] or o[3] < d[3]:
                    return True
        return False

    return sorted((d[4], KINDS[d[2]], d[0], d[1]) for d in found if not suppressed(d))


def example(pattern, made):
    """A text that the pattern fits."""
    while True:
        shorter = re.sub(
            r"\(\?:([^()]*)\)(\?|\{\d,\d\})?",
            lambda m: "" if m[2] in ("?", "{0,3}", "{0,8}") and made.random() < 0.5 else made.choice(m[1].split("|")),
            pattern,
        )
        if shorter == pattern:
            break
        pattern = shorter
    pattern = re.sub(r"\[(.)[^]]*\]", r"\1", pattern).replace(r"\S+", "some").replace(r"\S*", "s")
    return re.sub(r"(.)\?", r"\1", pattern).replace("+", "")


def some_texts(n=250):
    made = random.Random(11)
    glue = ["the", "and", "of", "or", "version", "license", "gpl", "v2", "2.0", "é", ",", "\n", "-"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(made.randint(1, 9)):
            parts.append(example(made.choice(SIGNATURES).pattern, made))
            parts += made.choices(glue, k=made.randint(0, 3))
        text = " ".join(parts)
        texts.append(text.title() if made.random() < 0.3 else text)
    return texts


FIXED = [
    None, "", "MIT", "Released under the MIT License.", "mit-license MIT/License é mit licenseé",
    "émit license", "Licensed under the Apache License, Version 2.0", "GNU General Public License v3",
    "GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0+", "plain prose without any",
    "mit license mit license", "KELVIN K license mit\u0000license", "General Public License",
]


def test_every_signature_is_met_and_passes_the_gate(spark):
    made = random.Random(1)
    texts = [example(s.pattern, made) for s in SIGNATURES]
    for s, text in zip(SIGNATURES, texts):
        words = said(text)
        spoken = " " + "  ".join(words) + " "
        assert re.search(f" ({licenses.spread(s.pattern)}) ", spoken), s
        assert s.keyword in spoken and any(stem in spoken for stem in licenses.GATE), s
    assert len(SIGNATURES) > 200 and len({s.label for s in SIGNATURES}) > 80


def test_against_a_plain_reading(spark):
    texts = FIXED + some_texts()
    got = scanned(spark, texts)
    n_suppressed = 0
    for i, text in enumerate(texts):
        words = said(text)
        want = detections(words, SIGNATURES)
        assert sorted(tuple(d) for d in got[i].detections) == want, text
        assert got[i].n_words == len(words)
        base = [
            (b.label, at)
            for b in licenses.BASE
            for at in range(len(words))
            if words[at : at + len(b.pattern.split())] == b.pattern.split()
        ]
        assert sorted(tuple(b) for b in got[i].base) == sorted(base)
        kinds = [KINDS.index(d[1]) for d in want] + [KINDS.index("name")] * bool(base)
        assert got[i].score == (licenses.WEIGHTS[min(kinds)] if kinds else 0)
        n_suppressed += len(want) > 0
    assert n_suppressed > 200


def test_query_against_sql(spark, tmp_path):
    texts = FIXED + some_texts(60)
    table = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    spark.createDataFrame(documents(spark, list(enumerate(texts))).collect()).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    frame = queries.QUERIES["op13_license_scan"](spark, str(tmp_path))
    with duckdb.connect() as connection:
        connection.register("documents", table)
        result = connection.execute(SQL["op13_license_scan"])
        names = [d[0] for d in result.description]
        want = sorted(result.fetchall(), key=lambda r: r[names.index("doc_id")])
    assert [tuple(r[c] for c in names) for r in frame.orderBy("doc_id").collect()] == want
    assert sorted(frame.columns) == sorted(names)


def test_priority_and_containment(spark):
    rules = [
        Signature("long", "title", "licen", "a licen[sc]e b c"),
        Signature("short", "title", "licen", "licen[sc]e b"),
        Signature("best", "tag", "licen", "c licen[sc]e"),
        Signature("late", "title", "licen", "licen[sc]e b"),
        Signature("low", "hint", "licen", "licen[sc]e"),
    ]
    got = scanned(spark, ["a license b c", "x license b", "a license b c license", "license"], rules)
    labels = {i: [tuple(d)[0] for d in r.detections] for i, r in got.items()}
    # The second rule beats its repetition; a better kind that only touches beats all.
    assert labels == {0: ["long"], 1: ["short"], 2: ["best"], 3: ["low"]}


def test_awkward_documents(spark):
    found = licenses.find_licenses(documents(spark))
    assert ids_of(found) == ALL_IDS
    assert licenses.find_licenses(documents(spark, [])).count() == 0


def test_work_grows_with_the_length(spark):
    """Very many detections in one text."""
    texts = ["mit license and gpl-3.0 or " * 4_000, LONG + " mit license"]
    start = time.perf_counter()
    got = scanned(spark, texts)
    assert time.perf_counter() - start < 60
    assert len(got[0].base) == 4_000 and len(got[0].detections) == 8_000


@pytest.mark.parametrize("name", ["op13_license_scan"])
def test_no_python_in_the_plan(spark, name, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    frame = queries.QUERIES[name](spark, str(tmp_path))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange"))
