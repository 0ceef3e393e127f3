"""Exact duplicates against a plain Python version."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from seedline.llm import exact_copies, sieve

WHITE = re.compile(r"[\x20\x09-\x0D]")


def plain(rows):
    """(doc_id, keep_id, group_size, kept) of rows (doc_id, text), with repeats."""
    groups = collections.defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[WHITE.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, place, doc_id))
    out = []
    for members in groups.values():
        best = min(members)
        out += [(m[4], best[4], len(members), m[3] == best[3]) for m in members]
    return out


def ordered(rows):
    return sorted(rows, key=repr)


def found(frame):
    return [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_copies.groups(frame).collect()]


def test_groups(spark, odd, none):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab \t\n\x0b\x1cé") for _ in range(rng.randint(0, 6))) for _ in range(600)]
    texts += ["x" * 70 + c for c in "aabbc"] + ["x" * 64, "x " * 64, None]  # alike to the end of the beginning
    rows = [(i, t) for i, t in enumerate(texts)]
    assert ordered(found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))) == ordered(plain(rows))
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert ordered(found(odd)) == ordered(plain(rows))
    assert found(none) == []


def test_refinement_reads_what_is_left(spark):
    rows = [(1, "alone by length"), (2, "ab"), (3, "cd"), (4, "same"), (5, "s a m e"), (6, "y" * 64 + "1"), (7, "y" * 64 + "2")]
    left = {r.doc_id: r.full for r in exact_copies.judged(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [left[i] is not None for i in range(1, 8)] == [False, False, False, True, True, True, True] and left[6] != left[7]


@pytest.mark.parametrize("slots", [1, 7])
def test_a_full_sieve_changes_nothing(spark, monkeypatch, slots):
    monkeypatch.setattr(sieve, "SLOTS", slots)
    rows = [(i, f"t {i % 5}" * (i % 3)) for i in range(60)]
    assert ordered(found(spark.createDataFrame(rows, "doc_id bigint, text string"))) == ordered(plain(rows))


def test_deduplicated(spark, odd, none):
    clash = odd.withColumn("own_id", F.lit("mine")).withColumn("row", F.lit("mine"))
    out = exact_copies.deduplicated(clash)
    assert out.columns == clash.columns and {(r.own_id, r.row) for r in out.collect()} == {("mine", "mine")}
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    stay = [r[0] for r in plain(rows) if r[3]]
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == sorted(map(repr, stay))
    assert exact_copies.deduplicated(none).count() == 0
