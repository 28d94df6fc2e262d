"""The pipeline's stages, each against its own input, and the whole run."""

import sys
from collections import Counter

import pytest

import corpus_pipeline
from test_jaccard import brute as components
from test_lines import brute as deduped
from test_packing import _check, _ids

from tickloom.llm import pii
from tickloom.llm.queries import PII_KEY, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = [table(spark, SF, "documents")]
    extra = [
        (9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "1 2 3", "en", "s", 0), (None, "the end of the story", None, None, None),
        (9004, "call (988) 555-2485 now " + "and then " * 40, "en", "s", 0), (9004, "call (988) 555-2485 now " + "and then " * 40, "en", "s", 0),
    ]
    docs[0] = docs[0].unionByName(spark.createDataFrame(extra, docs[0].schema))
    base = tmp_path_factory.mktemp("steps")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs[-1], SF).write.parquet(str(base / name))
        docs.append(spark.read.parquet(str(base / name)))
    return docs


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1])
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_language_keeps_what_has_letters(steps):
    before, after = Counter(texts(steps[0])), Counter(texts(steps[1]))
    assert not after - before
    gone = before - after
    assert {9001, 9002, 9003} <= {i for i, _ in gone}
    assert sum(gone.values()) <= 3 + 0.02 * sum(before.values())


def test_line_dedup(spark, steps):
    left = deduped(spark, texts(steps[1]))
    emptied = {i for i, t, removed in left if removed and t == ""}
    assert emptied
    assert Counter(texts(steps[2])) == Counter({(i, t): n for (i, t, _), n in left.items() if i not in emptied})


def test_one_document_of_each_group_stays(steps):
    rows = texts(steps[2])
    groups = components([r for r in rows if r[0] is not None], 5, 80, 100)
    first = {i for i, _, c in groups if i == c}
    assert Counter(texts(steps[3])) == Counter(r for r in rows if r[0] is None or r[0] in first)


def test_private_data(steps):
    p = pii.Permutation(PII_KEY)
    assert Counter(texts(steps[4])) == Counter((i, pii.pseudonyms(t, p)[0]) for i, t in texts(steps[3]))


def test_packing(steps):
    rows = [r for r in steps[5].collect() if r.doc_id not in (None, 9004)]
    own = [r for r in texts(steps[4]) if r[0] not in (None, 9004)]
    for r in rows:
        assert 0 <= r.offset and r.offset + r.length <= 1024
    got = Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)
    assert got == Counter((i, len(ids)) for (i, _), ids in zip(own, _ids([t for _, t in own])))
    assert callable(_check)


def test_run_equals_the_stages(spark, steps, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: steps[0])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(corpus_pipeline.run(spark, SF).select(columns).collect()) == Counter(steps[5].select(columns).collect())


def test_empty_table(spark, monkeypatch):
    docs = table(spark, SF, "documents").limit(0)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    assert corpus_pipeline.run(spark, SF).count() == 0


def test_nothing_else_needs_the_subpackage():
    assert not any("llm" in line for m in list(sys.modules) if m.startswith("tickloom.") and ".llm" not in m
                   and getattr(sys.modules[m], "__file__", None)
                   for line in open(sys.modules[m].__file__).read().splitlines() if "import" in line)
