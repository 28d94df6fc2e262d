import zlib

import numpy as np
import pytest

from tickloom.llm import langid
from tickloom.llm.queries import op5_language, table

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_documents(spark):
    docs = {d.doc_id: d for d in table(spark, SF, "documents").collect()}
    rows = op5_language(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    right = np.mean([r.lang_pred == docs[r.doc_id].lang for r in out])
    assert len(out) > 100 and right >= 0.95


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = langid.fit([b"abc", b"xyz"], ["a", "b"], seed=1)
    net = langid.Network(net.languages, *(v.astype(np.float64) for v in (net.table, net.turn, net.out, net.bias)))
    x = langid.padded([bytes(rng.integers(97, 100, n).tolist()) for n in (5, 3, 1)], 5)
    y = np.array([0, 1, 1])
    grads, _ = net.gradients(x, y)
    for value, grad in zip((net.table, net.turn, net.out, net.bias), grads):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in value.shape)
            if value is net.table:
                at = (at[0], at[1], 97 + at[2] % 3)
            old, losses = value[at], []
            for step in (1e-2, -1e-2):
                value[at] = old + step
                losses.append(net.gradients(x, y)[1])
            value[at] = old
            assert abs((losses[0] - losses[1]) / 2e-2 - grad[at]) < 2e-3


def test_pooling_equals_one_text_at_a_time(monkeypatch):
    net = langid.fit([b"the and of", b"der die das"], ["en", "de"])
    texts = [b"", b"a", b"the and of " * 100, b"der die" * 40, bytes(range(256)) * 2]
    monkeypatch.setattr(langid, "LANES", 3)
    got = langid.pooled(net, texts)
    for t, p in zip(texts, got):
        parts = [t[i : i + langid.SEGMENT] for i in range(0, len(t), langid.SEGMENT)]
        own = [net.chances(langid.padded([s], len(s)))[:, :, 0] for s in parts]
        assert np.allclose(p, np.concatenate(own).mean(axis=0) if own else 0, atol=1e-5)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(langid, "ROUNDS", 40)


def test_edge_cases(spark, small):
    words = {"en": "the cat and the dog", "de": "der hund und die katze"}
    rows = [(i, words[lang] + f" {i}", lang, 5) for i in range(40) for lang in words]
    rows += [(100, None, "en", 5), (101, "", "de", 5), (102, "12 34 !? ² ½ ৩", "en", 5), (103, (words["en"] + " ") * 6_000, None, 5), (104, "é", None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {(r.doc_id, r.lang): r for r in langid.identify(df, langid.train(df)).collect()}
    assert len(got) == len(rows)
    for i, lang in ((100, "en"), (101, "de"), (102, "en")):
        assert (got[i, lang].lang_pred, got[i, lang].score) == ("und", 0.0)
    assert got[103, None].lang_pred == "en" and got[104, None].lang_pred in words
    assert langid.identify(df.limit(0), langid.train(df.limit(0))).count() == 0
    nothing = langid.train(df.where("lang IS NULL"))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}
    one = langid.train(df.where("lang = 'en'"))
    assert {r.lang_pred for r in langid.identify(df, one).collect()} == {"und", "en"}


def test_sample_is_bounded_and_takes_each_text_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 5)
    rows = [("same text here", "en")] * 50 + [(f"text number {i}", "en") for i in range(100)] + [("ein text", "de")]
    segments, labels = langid.sample(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    assert labels.count("de") == 1 and 1 <= labels.count("en") <= 5
    assert segments.count(b"same text here") <= 1


def test_a_language_of_repeated_texts_is_learned(spark):
    rows = [("un texte", "fr"), ("autre texte", "fr")] * 10_000
    rows += [(f"text number {i}", "en") for i in range(50)] + [(f"ein text {i}", "de") for i in range(50)]
    _, labels = langid.sample(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    assert {k: labels.count(k) for k in set(labels)} == {"fr": 2, "en": 50, "de": 50}
