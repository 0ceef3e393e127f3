"""Spelling variants against plain Python."""

import collections
import random
import re
import zlib

import pytest

from seedline.llm import spelling


def plain_words(rows):
    found = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    out, form = [], {}
    for w, n in words.items():
        close = sorted((-m, v) for v, m in words.items() if near(w, v))
        if close and -close[0][0] >= 5 * n:
            form[w] = close[0][1]
        out.append([w, form.get(w), None, n, len(close), words[form[w]] if w in form else None])
    for row in out:
        row[2] = row[0]
        while row[2] in form:
            row[2] = form[row[2]]
    return sorted(map(tuple, out))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    base = ["letters", "lettres", "naïveté", "Straßen", "aaaaaaa", "abababab", "×÷×÷×÷", "misspelling"]

    def typed():
        word = rng.choice(base)
        while rng.random() < 0.35:
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:at] + rng.choice(["", "e", "é"]) * (kind > 0) + word[at + (kind != 1) :]
        return word

    return [(i if i % 9 else None, " ".join(typed() + rng.choice(["", ".", "漢", "😀"]) for _ in range(30))) for i in range(400)]


def test_counted(spark, monkeypatch, odd, none, rows):
    monkeypatch.setattr(spelling, "COUNTED_AT_ONCE", 7)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert {r.word: r.n for r in spelling.counted(frame).collect()} == plain_words(rows)
    small = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert {r.word: r.n for r in spelling.counted(odd).collect()} == plain_words(small)
    assert spelling.counted(none).count() == 0


def test_variants(spark, rows):
    words = plain_words(rows)
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    expected = plain_variants(words)
    assert sorted(map(tuple, spelling.variants(frame).collect())) == expected
    assert sum(r[4] for r in expected) > 100 and any(r[2] not in (r[0], r[1]) for r in expected)


def test_edges(spark):
    long = "x" * 4000 + "y" * 3000
    words = {long: 50, long[:-1]: 5, long[1:]: 6, "aa": 1, "a": 30, "": 200, "b": 5, "\U0001f600": 5, "chain": 5, "chains": 25, "chainsx": 125, "chainsxy": 625}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert sorted(map(tuple, spelling.variants(frame).collect())) == plain_variants(words)
    assert spelling.variants(frame.where("false")).count() == 0
