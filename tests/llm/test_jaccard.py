import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import jaccard
from tickloom.llm.components import stars
from tickloom.llm.queries import op1_jaccard, table
from tickloom.llm.shingles import Shingler

SF = "/root/testdata/sf0.01"


def shingles(text, k):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for j, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(j)
    for j, (a, s) in enumerate(sets):
        common = Counter(m for x in s for m in by[x] if m < j)
        for m, n in common.items():
            b, t = sets[m]
            if den * n >= num * (len(s) + len(t) - n):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(d.doc_id, d.text) for d in table(spark, SF, "documents").collect()]
    expected = brute(rows, 4, 85, 100)
    assert got(op1_jaccard(spark, SF)) == expected
    assert len({c for _, _, c in expected}) < len(expected) - 20


def edited(rng, words, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("k, num, den", [(1, 85, 100), (2, 80, 100), (5, 80, 100)])
def test_edited_copies_of_all_sizes(spark, k, num, den):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for size in [*range(1, 60), 80, 120, 200, 400]:
        base = [rng.choice(vocabulary) for _ in range(size)]
        for share in (0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1):
            texts.append(edited(rng, base, share) if share else base)
        texts += [base + common[: size // 3], base[: -max(1, size // 12)], [*base, "X"], [w.upper() for w in base]]
    rng.shuffle(texts)
    rows = [(i * 3, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(jaccard.components(df, k, num, den)) == brute(rows, k, num, den)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A\tB"), (6, "b a"), (7, "a b c d e f g"), (8, "a b c d e f g"),
        (8, "a b c d e f g"), (9, "q " * 30_000), (10, "Q " * 31_000), (11, "z" * 200_000), (12, "é É"), (13, "é é"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, key int")
    assert got(jaccard.components(df, 4, 85, 100)) == brute(rows, 4, 85, 100)
    assert jaccard.components(df.limit(0), 4, 85, 100).count() == 0
    null = spark.createDataFrame([(None, "a b"), (4, "a b")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.components(null, 4, 85, 100).collect()}
    assert found == {None: None, 4: 4}
    kept = jaccard.first_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 9, 11, 12, 13]


def test_empty_segments_lose_nothing(spark, monkeypatch):
    """Without spare segments many sets enter the lists of their empty ones."""
    monkeypatch.setattr(jaccard, "MOST_LIGHT", 0)
    monkeypatch.setattr(jaccard.Rule, "segments", lambda self, hi: (2 * hi * (self.den - self.num) // (self.den + self.num) + 1, 0))
    rng = random.Random(2)
    rows = []
    for n in range(150):
        base = [f"v{rng.randrange(300)}" for _ in range(rng.randrange(2, 90))]
        rows += [(4 * n + j, " ".join(edited(rng, base, 0.02) if j else base)) for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.components(df, 1, 80, 100)) == brute(rows, 1, 80, 100)


def test_lists_are_streamed_over_batches(spark):
    rng = random.Random(1)
    rows = sorted((rng.randrange(60), i) for i in range(200))
    df = spark.createDataFrame(rows, "key long, doc_id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = jaccard.scan_lists(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = {}
    for k, d in rows:
        by.setdefault(k, []).append(d)
    expected = sorted((k, d, min(ds)) for k, ds in by.items() if len(ds) > 1 for d in ds)
    assert sorted((r.key, r.doc_id, r.first) for r in found) == expected


def test_shingle_sets_equal_plain_sets():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab c\td\n") for _ in range(rng.randrange(40))) for _ in range(200)] + [None, "", "x"]
    sets = {}
    for at, ends, hashes in Shingler(3).sets(pa.array(texts, pa.string())):
        for i in range(len(ends) - 1):
            own = hashes[ends[i] : ends[i + 1]]
            assert (np.diff(own.view(np.uint64)) > 0).all()
            sets[at + i] = frozenset(own.tolist())
    plain = [frozenset(shingles(t, 3)) for t in texts]
    assert [len(sets[i]) for i in range(len(texts))] == [len(p) for p in plain]
    for i in range(len(texts)):
        assert [len(sets[i] & sets[j]) for j in range(len(texts))] == [len(plain[i] & plain[j]) for j in range(len(texts))]


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (20, 21), (21, 22), (22, 20), (7, 7), *((100 + i, 101 + i) for i in range(60))]
    found = {r.a: r.b for r in stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {4: 3, 5: 3, 9: 3, 21: 20, 22: 20, **{i: 100 for i in range(101, 161)}}
    assert stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_with_several_texts_has_the_links_of_all(spark):
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    first, second, third = words(30), words(30), words(60)
    rows = [(1, first), (1, second), (2, [*second, "extra"]), (3, third), (3, words(9)), (3, [*first, "more"]), (4, third)]
    rows += [(5, words(12)), (6, words(12))]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(4)
    found = {(r.doc_id, r.component_id) for r in jaccard.components(df, 4, 85, 100).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 6)}


def test_blocks_of_the_main_component_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    rng = np.random.default_rng(4)
    sketch = rng.integers(0, 2**62, 16, np.uint64)
    rows = []
    for i in range(300):
        own = sketch.copy()
        own[i % 16] ^= np.uint64(1 << (i % 60))
        root = 0 if i >= 15 else 1000 + i
        rows.append((7, i, 500, root, 0, own.tobytes()))
    listed = spark.createDataFrame(rows, "key long, rep long, n long, root long, main long, sketch binary").repartition(3)
    pairs = {(r.a, r.b) for r in jaccard.compare_lists(listed, jaccard.Rule(5, 80, 100)).collect()}
    assert pairs == {(a, b) for a in range(300) for b in range(min(a, 15))}
    plan = jaccard.compare_lists(listed, jaccard.Rule(5, 80, 100))
    dealt = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in dealt


def test_sets_are_gathered_for_likely_pairs_only(spark, monkeypatch):
    """Texts that share a passage meet in lists by chance; sketches rule those pairs out, of long texts too."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    passage = words(40)
    texts = [words(n) + passage for n in [*[200, 210, 220] * 60, *[3000, 3100, 3200] * 6]]
    texts += [edited(rng, texts[i], 0.01) for i in (0, 180)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    gathered, compared = [], []
    sets_of, compare = jaccard._sets_of, jaccard.compare_lists

    def recorded(docs, wanted, *rest):
        gathered.extend(r[0] for r in wanted.collect())
        return sets_of(docs, wanted, *rest)

    def dealt(listed, *rest):
        compared.append(listed.groupBy("key").count().agg({"count": "min"}).first()[0])
        return compare(listed, *rest)

    monkeypatch.setattr(jaccard, "_sets_of", recorded)
    monkeypatch.setattr(jaccard, "compare_lists", dealt)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jaccard.components(df, 4, 85, 100)) == brute(rows, 4, 85, 100)
    assert sorted(set(gathered)) == [0, 180, 198, 199]
    assert compared and compared[0] > 2


def test_sketches_rule_out_no_link(spark):
    """Pairs at and around the limit, of sizes whose sketches are of different width."""
    rng = np.random.default_rng(6)
    rule = jaccard.Rule(5, 80, 100)
    own, pairs, linked = [], [], set()
    for n in (5, 90, 1000, 1024, 1025, 2040, 2060, 5000):
        base = rng.integers(0, 2**64, 2 * n, np.uint64)
        for common, more in ((n, 0), (n, n // 4), (n, n // 4 + 1), (n - n // 9, n // 9), (n - n // 9 - 1, n // 9 + 1), (n // 2, n // 2)):
            a, b = len(own), len(own) + 1
            own += [np.sort(base[:n]), np.sort(np.r_[base[:common], base[n : n + more]])]
            pairs.append((b, a))
            if 100 * common >= 80 * (n + more):
                linked.add((b, a))
    ends = np.r_[0, np.cumsum([len(s) for s in own])]
    narrow, wide = (f(np.concatenate(own), ends) for f in (jaccard.sketches, jaccard.wide_sketches))
    assert [w is None for w in wide] == [len(s) <= jaccard.BITS for s in own]
    reps = [(i, len(s), narrow[i].tobytes(), wide[i]) for i, s in enumerate(own)]
    reps = spark.createDataFrame(reps, "rep long, n long, sketch binary, wide binary")
    left = {(r.a, r.b) for r in jaccard.likely(spark.createDataFrame(pairs, "a long, b long"), reps, rule).collect()}
    assert linked <= left
    assert not left & {p for p in pairs[5::6] if len(own[p[1]]) > 50}
