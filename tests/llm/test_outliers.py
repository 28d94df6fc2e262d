import re
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import outliers
from tickloom.llm.queries import op10_quality, table

SF = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, repeat = len(words), len(covered)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
        n < 50 or 100 * repeat > 50 * n,
    )


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query_counts_and_verdicts(spark):
    docs = {d.doc_id: d for d in table(spark, SF, "documents").collect()}
    rows = op10_quality(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == counts(docs[r.doc_id].text)
        assert not (r.base_failed and r.kept)
    good = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()}
    fine = [r for r in rows if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in fine) >= 0.97 * len(fine)


def test_edge_cases(spark):
    texts = [None, "", " \n\t", "a b c a b c", "x " * 60, "é ü " * 3, "a\n\nb\na\n \n \na", "w" * 200_000, "<|>#" * 9]
    rows = [(i, t, None if i % 2 else "en", "s", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = {r.doc_id: r for r in outliers.quality(df).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in COLUMNS) == counts(t)
    assert outliers.quality(df.limit(0)).count() == 0
    assert outliers.quality(df.union(df)).count() == 2 * len(rows)


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(4)
    words = [f"w{'abcdefgh'[i % 8] * (1 + i % 7)}" for i in range(3000)]
    rows = []
    for i in range(900):
        n = int(rng.lognormal(5, 0.4)) + 50
        text = " ".join(rng.choice(words, n))
        if i % 30 == 0:
            text = re.sub(" ", " ### $$$ ", text)
        elif i % 30 == 1:
            text = re.sub(r"\w+", lambda m: m.group() * 6, text)
        rows.append((i, text, "en", "a" if i < 800 else f"rare{i % 5}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_planted_outliers_go_and_the_rest_stays(planted):
    got = {r.doc_id: r.kept for r in outliers.quality(planted).collect()}
    bad = [i for i in got if i % 30 < 2 and i < 800]
    assert not any(got[i] for i in bad)
    assert all(kept for i, kept in got.items() if i % 30 > 1)


def test_distance_equals_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5)) @ rng.normal(size=(5, 5))
    df = spark.createDataFrame(
        [("k", i % outliers.SALTS, *map(float, v)) for i, v in enumerate(x)], ["_key", "_salt", *outliers.STATISTICS]
    )
    got = np.array([r._d for r in outliers.distances(df, outliers.moments(df)).orderBy("_x0").collect()])
    order = np.argsort(x[:, 0])
    spread = np.cov(x.T, bias=True) + np.diag([v * v for v in outliers.STATISTICS.values()])
    off = x[order] - x.mean(axis=0)
    assert np.allclose(got, np.einsum("ij,jk,ik->i", off, np.linalg.inv(spread), off))


def test_no_python_in_the_plan(spark):
    plan = op10_quality(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
