"""Texts made to be costly or odd: tables, attributes, runs of words and backslashes."""

from __future__ import annotations

import random
import time

import pytest

from harbor.llm import chat, secrets
from harbor.llm.html_text import FARTHEST_START, visible_text


@pytest.mark.parametrize("html, text", [
    ("<table><tr><td colspan=2>OK</td></tr></table>", "OK"),
    ("<table><tr><th>Price<td colspan=2>9</tr></table>", "Price  9"),
    ("<table><tr><td colspan=1000>all<td>y<tr><td>1<td>2</table>", "all   y\n1  2"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td rowspan=1000 colspan=1000>a</table>", "a"),
    ("<table><tr><td>a<td>b<tr><td colspan=2>wider than both<tr><td>c<td>d</table>",
     "a  b\nwider than both\nc  d"),
    ("<p><a title=Bob's>We don't stop</a>", "We don't stop"),
    ('<div class=a"b>x</div>', "x"),
    ('<a href="x>y" id=\'>\'>z</a> <br/>q<img alt=x/>w', "z\nqw"),
    ('<a title="not closed>z</a>', "z"),
    ("a <b", "a"),
    ("<math><mi>x</mi><annotation>no</annotation></math><svg><title>t</title><text>label</text></svg>",
     "xlabel"),
    ('<p style="visibility:hidden">a<b style="visibility: visible">b</b>c</p>', "b"),
    ('<p style="display:none">a<b style="visibility: visible">b</b>c</p>d', "d"),
])
def test_tables_attributes_and_visibility(html, text):
    assert visible_text(html) == text


def test_random_pages_end_and_keep_their_words():
    made = random.Random(4)
    tags = "p div table tr td th caption ul ol li b a span pre h1 thead tbody br hr select option dl dt dd".split()
    attributes = ["", " colspan=3", " rowspan=2", " colspan=1000 rowspan=1000", " start=5", ' title="a>b"',
                  " x='", ' y="', " hidden", " =", " style=visibility:hidden", " / z"]
    for _ in range(10_000):
        parts = []
        for n in range(made.randint(1, 25)):
            tag = made.choice(tags)
            parts.append(made.choice([
                f"<{tag}{made.choice(attributes)}>", f"</{tag}>", f"w{n} ", "<", "&lt;", "<!--", "-->", "\n",
            ]))
        visible_text("".join(parts))
    plain = [a for a in attributes if a not in (" hidden", " style=visibility:hidden", " x='", ' y="')]
    for _ in range(2_000):
        parts, words, n = [], [], made.randint(1, 25)
        for i in range(n):
            tag = made.choice("p div b a span h1 ul li ol dl dt dd pre".split())
            parts.append(f"<{tag}{made.choice(plain)}>w{i} </{tag}>" if made.random() < 0.7 else f"w{i} ")
            words.append(f"w{i}")
        got = [w for w in visible_text("".join(parts)).split() if w.startswith("w")]
        assert got == words


def test_tables_of_many_spans_take_little():
    start = time.perf_counter()
    rows = visible_text("<table>" + "<tr><td rowspan=1000 colspan=1000>x" * 1000 + "</table>")
    assert rows.split() == ["x"] * 1000
    wide = visible_text("<table><tr><td>" + "w" * 100_000 + "<td>x" + "<tr><td><td>y" * 5_000 + "</table>")
    assert len(wide) < 5_000 * (FARTHEST_START + 10) and wide.count("y") == 5_000
    for piece in ("<a ", '<a b="', "<a b='\"", "<table>", "<td rowspan=1000>x"):
        visible_text(piece * 20_000)
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize("text, n", [
    ("Abc-" * 10_000 + "a1b2", 0),
    ("Of" * 20_000 + "x9", 0),
    ("kQ3vX8pLm2Tz7Rw4sY" + "a" * 60, 1),
    (("kQ3vX8pLm2Tz7Rw4sY" + "a" * 60) * 1_000, 1_000),
])
def test_entropy_of_long_candidates(text, n):
    start = time.perf_counter()
    assert len(secrets.entropy_spans(text)) == n
    assert time.perf_counter() - start < 2


def test_very_many_backslashes(spark):
    texts = ["\\" * 1_000_000, "\\" * 1_000_000 + "</turn>", "\\ ### " * 50_000]
    rows = [(i, 0, "user", t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    start = time.perf_counter()
    got = {r.conv_id: r.turns[0].text for r in chat.format_conversations(frame).collect()}
    assert got == dict(enumerate(texts)) and time.perf_counter() - start < 20
