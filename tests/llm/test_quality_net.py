import zlib

import numpy as np
import pytest

from tickloom.llm import quality_net
from tickloom.llm.queries import op11_quality_net, table

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = op11_quality_net(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out and r.doc_id in labels]
    right = np.mean([r.predicted == labels[r.doc_id] for r in out])
    clean = [r for r in out if labels[r.doc_id] == 1]
    assert len(out) > 50 and right >= 0.93
    assert np.mean([r.predicted for r in clean]) >= 0.98


def test_gradients_equal_finite_differences(monkeypatch):
    monkeypatch.setattr(quality_net, "CHUNK", 24)
    rng = np.random.default_rng(0)
    net = quality_net.fit([], [])
    net.out[:] = rng.normal(size=quality_net.FILTERS)
    net.shift[:] = rng.normal(0, 0.1, quality_net.FILTERS)
    x = quality_net.padded([bytes(rng.integers(97, 110, n).tolist()) for n in (24, 20, 9, 3)])
    y = np.array([0.0, 1.0, 1.0, 0.0])
    values = [net.byte, net.kernel, net.shift, net.out, net.bias]
    grads, _ = net.gradients(x, y)
    for value, grad in zip(values, grads, strict=True):
        for _ in range(8):
            at = tuple(rng.integers(0, s) for s in value.shape)
            if value is net.byte:
                at = (97 + at[0] % 13, at[1])
            old, losses = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = old + step
                losses.append(net.gradients(x, y)[1])
            value[at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - grad[at]) < 1e-5


@pytest.mark.parametrize("size", [0, 1, 7, 8, 255, 256, 257, 505, 506, 5_000])
def test_chunks_cover_every_window(size):
    own = quality_net.places(size)
    assert len(set(own)) == len(own) and all(p + quality_net.CHUNK <= max(size, quality_net.CHUNK) for p in own)
    windows = {p + k for p in own for k in range(quality_net.STRIDE)}
    assert windows >= set(range(size - quality_net.WIDTH + 1))


def test_scores_equal_a_plain_convolution(monkeypatch):
    monkeypatch.setattr(quality_net, "LANES", 3)
    monkeypatch.setattr(quality_net, "ROUNDS", 5)
    net = quality_net.fit([b"clean words here", b"### $$$ %%%"], [1, 0])
    texts = [b"", b"a", b"clean words here " * 60, bytes(range(256)) * 3]
    got = quality_net.scores(net, net.tables(), texts)
    for text, p in zip(texts, got, strict=True):
        logits = []
        for at in quality_net.places(len(text)):
            own = [*text[at : at + quality_net.CHUNK]]
            own += [quality_net.PAD] * (quality_net.CHUNK - len(own))
            answers = [
                sum(net.byte[own[i + k]] @ net.kernel[k] for k in range(quality_net.WIDTH)) for i in range(quality_net.STRIDE)
            ]
            logits.append(np.maximum(np.max(answers, axis=0) + net.shift, 0) @ net.out + net.bias[0])
        assert abs(p - 1 / (1 + np.exp(-np.mean(logits)))) < 1e-5


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(quality_net, "ROUNDS", 60)
    rows = [(i, f"some clean words number {i} stand here", 1, "x", 5) for i in range(60)]
    rows += [(100 + i, f"### $$$ {i} %%% &&& !!!", 0, "x", 5) for i in range(60)]
    rows += [(200, None, 1, "x", 5), (201, "", 0, "x", 5), (202, "clean words " * 20_000, None, None, 5), (None, "é", 7, "x", 5)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, score string, predicted int")
    net = quality_net.train(df.select('doc_id', 'text'), df)
    got = quality_net.score(df, net).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[200].score == by[201].score and by[202].predicted == 1
    assert np.mean([by[i].predicted for i in range(60)]) == 1 and np.mean([by[100 + i].predicted for i in range(60)]) < 0.1
    assert quality_net.score(df.limit(0), quality_net.train(df, df.limit(0))).count() == 0
    assert {r.score for r in quality_net.score(df, quality_net.train(df, df.limit(0))).collect()} == {0.5}
    assert {r.predicted for r in quality_net.score(df, quality_net.train(df, df.where("quality = 0"))).collect()} == {0}
    assert {r.predicted for r in quality_net.score(df, quality_net.train(df, df.where("quality = 1"))).collect()} == {1}


def test_sample_is_bounded_and_repeats_crowd_out_nothing(spark, monkeypatch):
    monkeypatch.setattr(quality_net, "SAMPLE", 10)
    rows = [("one text that is very often there", 1)] * 5_000 + [("another one", 1)] * 5_000
    rows += [(f"rare text {i} " * 100, 0) for i in range(200)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, quality int")
    chunks, labels = quality_net.sample(df, df, "doc_id", "text", "quality")
    assert set(c for c, y in zip(chunks, labels) if y) == {b"one text that is very often there", b"another one"}
    assert labels.count(0) <= 10 * quality_net.CROPS and len(set(chunks)) == len(chunks)
