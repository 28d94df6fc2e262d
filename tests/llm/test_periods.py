import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import periods
from tickloom.llm.queries import op12_periods, table

SF = "/root/testdata/sf0.001"


def slow_runs(words):
    """Every lag, word by word; of equal stretches the smallest period."""
    found, n = {}, len(words)
    for lag in range(1, n // 4 + 1):
        i = 0
        while i + lag < n:
            if words[i] != words[i + lag]:
                i += 1
                continue
            start = i
            while i + lag < n and words[i] == words[i + lag]:
                i += 1
            if i - start + lag >= max(6, 4 * lag):
                found.setdefault((start, i - start + lag), lag)
    return sorted((s, n, q) for (s, n), q in found.items())


def fast_runs(words):
    return sorted(map(tuple, periods.search([[str(w).encode() for w in words]])[0].runs.tolist()))


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *facts, sha(listed), sha(kept))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in op12_periods(spark, SF).collect()}
    short = [d for d in docs if len(d[1] or "") < 12_000]
    assert len(got) == len(docs) and len(short) > 150
    assert [got[i] for i, _ in short] == [expected(i, t) for i, t in short]
    assert sum(r[1] > 0 for r in got.values()) > 5 and max(r[4] or 0 for r in got.values()) > periods.SCAN


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_planted_runs_of_all_periods(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10**9)))
    words, letters = [], data.draw(st.sampled_from([1, 2, 3, 50]))
    for _ in range(data.draw(st.integers(1, 4))):
        words += rng.integers(0, letters, rng.integers(0, 30)).tolist()
        block = rng.integers(0, letters, data.draw(st.integers(1, 70))).tolist()
        many = data.draw(st.integers(1, 9))
        words += (block * many)[: len(block) * many - int(rng.integers(0, len(block)))]
    assert fast_runs(words) == slow_runs(words)


def test_every_period_around_the_scales():
    rng = np.random.default_rng(5)
    for q in [*range(1, 70), 127, 128, 129, 255, 256, 257, 300]:
        block = list(range(q))
        tail = rng.integers(1000, 1010, 3).tolist()
        for n in (4 * q - 1, 4 * q, 4 * q + 1, 5 * q + q // 2):
            words = tail + (block * 6)[:n] + tail
            want = [(3, n, q)] if n >= max(6, 4 * q) else []
            assert fast_runs(words) == want


def test_nested_runs_and_multiples():
    inner = ["a", "b"] * 4
    words = (inner + ["c"]) * 5
    assert fast_runs(words) == slow_runs(words)
    assert len(fast_runs(words)) == 6
    assert fast_runs(["x"] * 1000) == [(0, 1000, 1)]
    assert fast_runs(list("ab") * 500) == [(0, 1000, 2)]


def test_documents_do_not_touch():
    same = [[b"a"] * 4, [b"a"] * 4, [b"a"] * 6, [], [b"b"]]
    assert [len(f.runs) for f in periods.search(same)] == [0, 0, 1, 0, 0]


def test_time_is_linear_in_one_long_run():
    import time

    took = []
    for n in (100_000, 400_000):
        words = [b"%d" % (i % 37) for i in range(n)]
        began = time.perf_counter()
        assert periods.search([words])[0].runs.tolist() == [[0, n, 37]]
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0]


@pytest.mark.parametrize("piece", [64, 4 << 20])
def test_edge_cases(spark, monkeypatch, piece):
    from tickloom.llm import fields

    monkeypatch.setattr(fields, "PIECE", piece)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 6), (5, "a " * 5), (6, "x\x1fy " * 8), (6, "one two"), (None, "b b b b b b")]
    rows += [(k, " ".join(f"w{i % 7}" for i in range(40))) for k in range(10, 60)] + [(99, "q " * 30_000)]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, period int, runs string")
    got = periods.digests(df, rewrite=periods.looped)
    key = lambda r: tuple(map(str, r))
    want = [expected(i, t) for i, t in rows if i != 99] + [(99, 1, 0, 30_000, 1, 30_000_000, *[hashlib.sha256(t).hexdigest() for t in (b"0,30000,1\n", b"q")])]
    assert sorted((tuple(r[c] for c in NAMES) for r in got.collect()), key=key) == sorted(want, key=key)
    assert periods.digests(df.limit(0)).count() == 0
    plain = {(r.doc_id, r.text): r.runs for r in periods.collapse(df).collect()}
    assert plain[1, None] == [] and plain[2, ""] == [] and plain[6, "one two"] == []
    assert [tuple(r) for r in plain[99, "q"]] == [(0, 30_000, 1)]
    assert periods.collapse(df.limit(0)).count() == 0
