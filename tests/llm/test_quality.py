"""Quality rules against their SQL and against numpy."""

from collections import Counter

import duckdb
import numpy as np

from corpus_pipeline import keep_quality
from surveypulse.llm.quality import CUT, FACTOR, LEAST, SHARE, SLACK, STEPS, measured, oracle, quality_rules


def test_against_sql(spark, stored):
    con = duckdb.connect()
    path = stored.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    # The SQL tells rows apart by doc_id.
    con.execute(f"CREATE VIEW documents AS SELECT DISTINCT * FROM '{path}/*.parquet' WHERE doc_id IS NOT NULL")
    once = stored.where("doc_id IS NOT NULL").distinct()
    got = quality_rules(once).select("doc_id", "_q.*")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(oracle()).fetchall())


def test_outliers_against_numpy(spark):
    """Two groups of which a tenth is odd; the odd ones are found, and as numpy finds them."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(240):
        odd = i % 10 == 3
        words = [("w" * (9 if odd else 3 + int(rng.integers(0, 4)))) + chr(97 + j % 26) + chr(97 + j // 26) + ("###" if odd else "") for j in range(60 + int(rng.integers(0, 60)))]
        rows.append((i, " ".join(words), "en" if i % 2 else None, "s"))
    rows += [(1000 + i, "x " + str(i), "tiny", "s") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules(docs).select("doc_id", "_q.*").collect()}
    counts = {r.doc_id: r["_q"] for r in measured(docs).collect()}
    for lang in (None, "en"):
        ids = [r[0] for r in rows if r[2] == lang]
        x = np.array([[np.log(1 + q.n_words), np.log(1 + q.word_chars / q.n_words), np.sqrt(q.n_symbols / q.n_words),
                       np.sqrt(q.n_dup_lines / q.n_lines), np.sqrt(q.n_repeat_words / q.n_words)] for q in (counts[i] for i in ids)])
        assert len(ids) >= LEAST

        def low(b, share):
            b = np.sort(b)
            return b[int(np.ceil(share * len(b))) - 1]

        m = np.array([low(np.floor(c * 256), 0.5) / 256 for c in x.T])
        d = np.array([low(np.floor(np.abs(c) * 256), 0.5) / 256 for c in (x - m).T])
        cov = np.diag((1.4826 * d) ** 2 + np.array(SLACK) ** 2)
        for _ in range(STEPS):
            d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
            bins = np.floor(np.log(d2 + 1e-6) * 64)
            near = x[bins <= low(bins, SHARE)]
            m, cov = near.mean(0), FACTOR * np.cov(near.T, bias=True) + np.diag(np.array(SLACK) ** 2)
        d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
        assert [got[i].kept for i in ids] == (d2 <= CUT).tolist() == [i % 10 != 3 for i in ids]
    assert not any(got[1000 + i].kept for i in range(3))


def test_passes_columns_and_empty(stored, nothing, nulls):
    got = quality_rules(stored, keep=tuple(stored.columns))
    assert got.columns == [*stored.columns, "_q"]
    as_rows = lambda df: Counter(map(tuple, df.select(*stored.columns).collect()))
    assert as_rows(got) == as_rows(stored)
    assert quality_rules(nothing).count() == 0
    assert [(r.n_words, r.base_failed, r.kept) for r in quality_rules(nulls).select("_q.*").collect()] == [(0, True, False)] * 3


def test_small_groups_are_judged_by_pooled_estimates(spark):
    """Sources of three documents each: the odd ones go by their language's estimate, and in languages
    as small by that of all; groups that are large enough keep their own verdicts."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        odd = i % 15 == 4
        words = [("w" * (3 + int(rng.integers(0, 4)))) + chr(97 + j % 26) + chr(97 + j // 26) + ("###" if odd else "") for j in range(60 + int(rng.integers(0, 60)))]
        lang, source = ("en", f"s{i // 3}") if i < 60 else ("de", "s") if i < 120 else (f"l{i // 3}", "s")
        rows.append((i, " ".join(words), lang, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    odd = {i for i in range(150) if i % 15 == 4}
    assert {r.doc_id for r in quality_rules(docs).where("_q.kept").collect()} == set(range(150)) - odd
    assert {r.doc_id for r in keep_quality(spark, docs, "").collect()} == set(range(150)) - odd
