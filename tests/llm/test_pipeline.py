"""The pipeline, stage by stage, against plain Python over whole texts; the discriminant also against numpy."""

import base64
import collections
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from seedline.llm import byte_bpe, mixing, quality, secret_scan

FOLDER = "/root/testdata/sf0.001"


def plain_scores(spark, docs, labels):
    """doc_id -> score of a shrunk quadratic discriminant over the written statistics, by determinants and solves."""
    rows = {r.doc_id: np.array(r._q) for r in quality.measured(docs).collect()}
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    groups = [np.array([x for d, x in rows.items() if known.get(d) == k]) for k in (0, 1)]
    total = sum(map(len, groups))
    own = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own)) / total
    densities = []
    for g, cov in zip(groups, own):
        cov = (1 - quality.SHRINK_TO_POOLED) * cov + quality.SHRINK_TO_POOLED * pooled
        cov = (1 - quality.SHRINK_TO_DIAGONAL) * cov + quality.SHRINK_TO_DIAGONAL * np.diag(np.diag(cov)) + quality.FLOOR * np.eye(len(cov))
        apart = {d: x - g.mean(axis=0) for d, x in rows.items()}
        densities.append({d: np.log(len(g) / total) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * a @ np.linalg.solve(cov, a) for d, a in apart.items()})
    return {d: 1 / (1 + np.exp(-quality.TEMPERATURE * (densities[1][d] - densities[0][d]))) for d in rows}


def plain_representatives(texts):
    """The least id of each component of links of 0.8 or more between sets of five-word windows."""

    def windows(text):
        words = (text or "").split()
        width = min(5, len(words))
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()

    sets, parent = {d: windows(t) for d, t in texts.items()}, {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if texts[a] == texts[b] or both and both >= 0.8 * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {d for d in ids if root(d) == d}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The table after each stage, written and read as run() does."""
    folder = tmp_path_factory.mktemp("stages")
    tables = {"": spark.read.parquet(f"{FOLDER}/documents.parquet")}
    docs = tables[""]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = tables[name] = spark.read.parquet(str(folder / name))
    return folder, tables


def test_stages_are_in_order_and_keep_the_columns(stages):
    _, tables = stages
    assert list(tables) == ["", "quality", "near_duplicates", "secrets", "mixing", "tokens"]
    assert all(t.columns == tables[""].columns for name, t in tables.items() if name != "tokens")


def test_quality_stage_is_the_plain_discriminant(spark, stages):
    _, tables = stages
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    wanted = plain_scores(spark, tables[""], labels)
    got = {r.doc_id: r.score for r in quality.scored(tables[""], labels).collect()}
    assert got.keys() == wanted.keys() and max(abs(got[d] - wanted[d]) for d in got) < 1e-6
    kept = {r.doc_id for r in tables["quality"].collect()}
    sure = {d: s for d, s in wanted.items() if abs(s - quality.THRESHOLD) > 1e-6}
    assert len(sure) > 150 and kept & sure.keys() == {d for d, s in sure.items() if s > quality.THRESHOLD}


def test_near_duplicates_stage_keeps_one_of_each_group(stages):
    _, tables = stages
    texts = {r.doc_id: r.text for r in tables["quality"].collect()}
    kept = {r.doc_id: r.text for r in tables["near_duplicates"].collect()}
    assert kept.keys() == plain_representatives(texts) and len(kept) < len(texts)
    assert all(texts[d] == t for d, t in kept.items())


def test_secrets_stage_masks_what_the_forest_finds(stages):
    _, tables = stages
    before = {r.doc_id: r.text for r in tables["near_duplicates"].collect()}
    after = {r.doc_id: r for r in tables["secrets"].collect()}
    found = collections.defaultdict(set)
    for r in secret_scan.findings(tables["near_duplicates"]).collect():
        found[r.doc_id].add(r.token)
    assert after.keys() == before.keys()
    for d, row in after.items():
        text = before[d]
        for token in sorted(found[d], key=len, reverse=True):
            text = text.replace(token, secret_scan.MASK)
        assert row.text == text and (not found[d] or row.n_chars == len(text))


def test_mixing_stage_takes_the_shares(stages):
    folder, tables = stages
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/secrets/*.parquet'")
    columns = [c[0] for c in con.execute(mixing.MIX_SQL).description]
    taken = {r["doc_id"]: r["taken"] / r["size"] for r in (dict(zip(columns, row)) for row in con.execute(mixing.MIX_SQL).fetchall()) if r["size"]}
    copies = collections.Counter(r.doc_id for r in tables["mixing"].collect())
    assert copies.keys() <= taken.keys() and max(copies.values()) <= 3
    assert all(abs(copies[d] - n) <= 0.5 + 1e-9 for d, n in taken.items())


def test_tokens_stage_and_run_give_the_ids_of_the_plain_library(spark, stages):
    _, tables = stages
    with open(public_tokenizers.path(byte_bpe.MULTI_VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = sorted((r.doc_id, tuple(known.encode_ordinary(r.text or ""))) for r in tables["mixing"].collect())
    assert sorted((r.doc_id, tuple(r.ids)) for r in tables["tokens"].select("doc_id", "ids").collect()) == ids
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r.doc_id, tuple(r.ids)) for r in whole.select("doc_id", F.col("ids")).collect()) == ids
