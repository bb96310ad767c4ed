"""The pipeline, stage by stage and as a whole, against plain Python on each stage's own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from surveypulse.llm.minhash import shingles
from surveypulse.llm.pii import base_spans


def close_pairs(rows):
    sets = [shingles(r.text, 5) for r in rows]
    for k, a in enumerate(sets):
        for j, b in enumerate(sets[:k]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                yield rows[j], rows[k]


@pytest.fixture(scope="module")
def steps(spark, stored, tmp_path_factory):
    """Each stage's input and output."""
    docs, out = stored, []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, "").write.parquet(path)
        new = spark.read.parquet(path)
        out.append((name, docs, new))
        docs = new
    return out


def test_columns_and_decisions(steps):
    names = [n for n, _, _ in steps]
    assert names == ["quality rules", "minhash near-dedup", "substring dedup", "personal data", "best-fit packing"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns
        assert all(r.n_chars == len(r.text) for r in after.collect()) or after is steps[0][2] or after is steps[1][2]
    before, after = steps[0][1].collect(), steps[0][2].collect()
    assert not [r for r in after if len((r.text or "").encode().split()) < 50]
    assert not Counter(after) - Counter(before) and len(after) < len(before)


def test_one_of_each_group(steps):
    _, before, after = steps[1]
    before, after = before.collect(), after.collect()
    assert list(close_pairs(before)) and not list(close_pairs([r for r in after if r.doc_id is not None]))
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    linked = {b.doc_id for a, b in close_pairs(before)} | {a.doc_id for a, b in close_pairs(before)}
    assert gone <= linked


def test_passages_and_personal_data(steps):
    _, before, after = steps[2]
    seen = set()
    for r in sorted(after.where("doc_id IS NOT NULL").collect(), key=lambda r: r.doc_id):
        w = r.text.split()
        mine = {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
        assert not mine & seen
        seen |= mine
    assert not any(base_spans(r.text) for r in steps[3][2].collect())


def test_packed_rows(spark, steps, stored, tmp_path):
    last = steps[-1][2].collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in steps[3][2].collect()}
    assert all(r.offset + r.length <= 2048 for r in last)
    stored.write.parquet(str(tmp_path / "documents.parquet"))
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pick = lambda rows: Counter(tuple(r)[:5] for r in rows)
    assert pick(whole) == pick(last)


def test_no_documents(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_columns_of_any_name(spark, stored, tmp_path):
    """Names that operators use themselves, on columns of the caller."""
    clash = {"_q": "key", "_g": "part", "_text_hash": "key", "_n_words": "part", "_kept_id": "key", "others": "key", "x.y": "part"}
    docs = stored.select("*", *[F.col(of).alias(name) for name, of in clash.items()])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        plain = stage(spark, stored, "").select("doc_id", "text")
        want = Counter(map(tuple, plain.collect()))
        path = str(tmp_path / f"stage{i}")
        stage(spark, docs, "").write.parquet(path)
        got = spark.read.parquet(path)
        assert got.columns == docs.columns
        assert Counter(map(tuple, got.select("doc_id", "text").collect())) == want
        assert got.where("NOT (_q <=> key) OR NOT (_n_words <=> part) OR NOT (`x.y` <=> part)").isEmpty()
