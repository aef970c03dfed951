"""Filter audit against all orders, one document at a time."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

from harbor.llm import audit

WORDS = ["one", "Two", "drei", "X", "YES", "a|b", "$5", "über", "\x0b", "fin e"]
COLUMNS = "doc_id long, text string, source string, A string, kept string, part string, step string"


def documents(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], COLUMNS)


def labels(spark, rows):
    schema = "doc_id long, quality int, toxic int, source string, E string"
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], schema)


def failing(rows):
    """The failed filters of every row, by the words of the contract."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }
        yield {name for name, failed in fails.items() if failed}


def by_brute_force(rows, marks):
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    bad = {i for i, _, t in marks if t == 1 and i is not None}
    told = [(part or "", i, fails) for (i, _, part), fails in zip(rows, failing(rows))]
    want, shapley = {}, Counter()
    for part in {p for p, _, _ in told}:
        for order in permutations("ABCDE"):
            left = [(i, fails) for p, i, fails in told if p == part]
            everyone = list(left)
            for step, name in enumerate(order, 1):
                gone = [i for i, fails in left if name in fails]
                left = [(i, fails) for i, fails in left if name not in fails]
                shapley[part, name] += len(gone)
                want[part, "".join(order), step] = (
                    len(left),
                    len(gone),
                    sum(name in fails for _, fails in everyone) - len(gone),
                    sum(fails == {name} for _, fails in everyone),
                    sum(i in good for i in gone),
                    sum(i in bad for i in gone),
                )
    return {
        (part, order, step): (*counts, shapley[part, order[step - 1]])
        for (part, order, step), counts in want.items()
    }


def some_rows():
    made = random.Random(5)
    texts = [None, "", " \n", "x", "one " * 300, "A" * 50]
    for _ in range(40):
        pool = made.sample(WORDS, made.randint(1, 6)) + [f"w{i}" for i in range(made.choice([0, 300]))]
        texts.append(" ".join(made.choice(pool) for _ in range(made.randint(1, 500))))
    rows = [
        (made.choice([None, *range(60)]), made.choice(texts), made.choice(["a", "b", None, ""]))
        for _ in range(250)
    ]
    return rows + rows[:20]


def test_against_all_orders(spark):
    rows = some_rows()
    marks = [(i, i % 2, i % 3 % 2) for i in range(0, 50)]
    marks += [(3, 0, 1), (4, None, None), (None, 1, 1), (5, 1, 0), (5, 1, 0), (99, 1, 1)]
    got = audit.audit_documents(documents(spark, rows), labels(spark, marks)).collect()
    want = by_brute_force(rows, marks)
    assert len(got) == len(want) == 600 * 3
    for r in got:
        assert want[r.part, r.filter_order, r.step] == (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley,
        )


def test_empty_tables(spark):
    empty = documents(spark, []), labels(spark, [])
    assert audit.audit_documents(*empty).count() == 0
    got = audit.audit_documents(documents(spark, [(1, None, None)]), empty[1])
    assert got.count() == 600 and got.where("part = '' and good_lost = 0").count() == 600
    assert got.where("filter_order like 'A%' and step = 1 and removed = 1").count() == 24


def test_a_text_of_very_many_rows(spark):
    """Only the smallest id passes E, and no group holds the copies."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'same' AS text", "'s' AS source")
    found = audit.document_failures(docs)
    assert found.where("not E").collect()[0].doc_id == 0 and found.where("E").count() == 19_999
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan


def test_two_filters(spark):
    rows = spark.createDataFrame(
        [("p", True, False), ("p", True, True), ("p", None, True), (None, False, False)],
        "part string, X boolean, Y boolean",
    )
    got = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley)
        for r in audit.audit(rows, "XY", {}).collect()
    }
    assert got["p", "XY", 1] == (1, 2, 0, 1, 3) and got["p", "XY", 2] == (0, 1, 1, 1, 3)
    assert got["p", "YX", 1] == (1, 2, 0, 1, 3) and got[None, "XY", 2] == (1, 0, 0, 0, 0)
    assert len(got) == 8
