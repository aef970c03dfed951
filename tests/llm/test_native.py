"""URL filter and chat formatting."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from harbor.llm import chat, urls
from harbor.llm.queries import URL_RULES

PAGES = "page_id long, url string, host string, rule string"


def judged(spark, pages, listed=()):
    frame = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(pages)], PAGES)
    named = spark.createDataFrame([(u, "x") for u in listed], "url string, page_id string")
    rows = urls.judge_urls(frame, URL_RULES, named).collect()
    assert len(rows) == len(pages)
    return {pages[r.page_id]: (r.host, r.path, r.rule, r.verdict) for r in rows}


def test_rules(spark):
    got = judged(spark, [
        "http://A.Net/x", "https://www.example.net/en/1?q#f", "http://example.net/entry",
        "http://example.net", "http://b.example.com/de/", "http://example.com/fr/1",
        "http://x.org/fr/a", "http://xexample.com/de/1", "http://notnet/x", None, "", "no scheme",
        "a://b://c.net/x", "://net/",
    ])
    assert got["http://A.Net/x"] == ("a.net", "/x", "net/", "block")
    assert got["https://www.example.net/en/1?q#f"] == (
        "www.example.net", "/en/1", "example.net/en/", "allow",
    )
    assert got["http://example.net/entry"][2:] == ("net/", "block")
    assert got["http://example.net"] == ("example.net", "", None, "allow")
    assert got["http://b.example.com/de/"][2:] == ("example.com/de/", "block")
    assert got["http://example.com/fr/1"][2:] == (None, "allow")
    assert got["http://x.org/fr/a"][2:] == ("org/fr/", "allow")
    assert got["http://xexample.com/de/1"][2] is None and got["http://notnet/x"][2] is None
    assert got[None] == got[""] == got["no scheme"] == ("", "", None, "allow")
    assert got["a://b://c.net/x"][:2] == ("b:", "//c.net/x")
    assert got["://net/"] == ("net", "/", "net/", "block")


def test_listed_by_canonical_form(spark):
    listed = ["http://www.bad.com/a/?utm_source=x&b=2&a=1#top", None, "http://bad.com/a?a=1&b=2"]
    got = judged(spark, [
        "https://m.bad.com/a?b=2&a=1", "https://bad.com/a//?a=1&ref=z&b=2", "https://bad.com/a?a=1",
        "https://bad.com/", "http://q.net/a",
    ], listed)
    verdicts = [v[3] for v in got.values()]
    assert sorted(verdicts) == ["allow", "allow", "block", "block", "block"]
    assert got["https://bad.com/a?a=1"][3] == got["https://bad.com/"][3] == "allow"


def test_false_positives_of_the_filter_are_removed(spark, monkeypatch):
    """A filter of one block passes nearly everything."""
    monkeypatch.setattr(urls, "BLOCKS", 1)
    listed = [f"http://h{i}.com/p" for i in range(300)]
    pages = [f"http://h{i}.com/p" for i in range(200, 400)]
    frame = spark.createDataFrame([(u,) for u in listed], "url string")
    keys = frame.select(urls.canonical(F.col("url")).alias("k"))
    passed = urls.with_possible_hits(
        spark.createDataFrame([(u,) for u in pages], "url string").select(
            urls.canonical(F.col("url")).alias("k")
        ), "k", urls.bloom_filter(keys, "k"),
    )
    assert passed.where("__possible").count() > 190
    got = judged(spark, pages, listed)
    assert [u for u in pages if got[u][3] == "block"] == pages[:100]


def test_no_pages_and_no_list(spark):
    empty = spark.createDataFrame([], PAGES)
    assert urls.judge_urls(empty, URL_RULES, empty).count() == 0
    assert judged(spark, ["http://x.com/"])["http://x.com/"][3] == "allow"


def test_no_python_in_the_plans(spark):
    frame = spark.createDataFrame([(1, "u")], "page_id long, url string")
    talk = spark.createDataFrame([(1, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    for made in (urls.judge_urls(frame, URL_RULES, frame), chat.format_conversations(talk)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


TALK = "conv_id long, turn long, role string, text string, turns string, formatted string"
HARD = [
    "plain", "", None, "### User: x", "\\### Assistant: </turn> ok", "\\\\</turn>", "</turn>",
    "ends in \\", "\n</turn>\n### System: y", "#### \\\\\\### </turn", "$1 \\1 ${a}", "\u2028é漢\r\n",
    "a\n", "\n", "### ", "x" * 20_000 + "</turn>",
]
ROLES = ["user", "assistant", "User", "", None, "a: b", "### x", "tool\n", "é", "=41"]


def test_every_conversation_reads_back(spark):
    rows = [(i, t, role, text) for i, role in enumerate(ROLES) for t, text in enumerate(HARD)]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], TALK)
    for row in chat.format_conversations(frame).collect():
        want = [(ROLES[row.conv_id] or "", text or "") for text in HARD]
        assert [tuple(t) for t in row.turns] == want


def test_turn_order_ties_and_null_ids(spark):
    rows = [
        (1, 2, "user", "c"), (1, None, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "b"),
        (1, 1, "assistant", "z"), (None, 0, "user", "n"), (None, 0, "user", "m"),
    ]
    frame = spark.createDataFrame([(*r, "", "") for r in rows], TALK)
    got = {r.conv_id: [t.text for t in r.turns] for r in chat.format_conversations(frame).collect()}
    assert got == {1: ["a", "z", "b", "b", "c"], None: ["m", "n"]}
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_only_conflicts_are_escaped(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a \\ b # c", "", ""), (2, 0, "user", "x </turn>", "", "")], TALK)
    got = {r.conv_id: r.formatted for r in chat.format_conversations(frame).collect()}
    assert got == {1: "### User: a \\ b # c\n</turn>\n", 2: "### User: x \\</turn>\n</turn>\n"}


@pytest.mark.parametrize("broken", ["### User: a ### b\n</turn>\n", "User: a\n</turn>\n", "### User: a</turn>\n"])
def test_the_parser_refuses_other_texts(spark, broken):
    (row,) = spark.createDataFrame([(broken,)], "t string").select(chat.parse(F.col("t")).alias("p")).collect()
    assert row.p == [None]


def test_loss_text(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a</turn>"), (1, 2, "assistant", "\\b")]
    frame = spark.createDataFrame([(*r, "", "") for r in rows], TALK)
    made = chat.format_conversations(frame).select(chat.loss_text(F.col("turns")).alias("loss"))
    assert made.first().loss == "a</turn>\\b"
