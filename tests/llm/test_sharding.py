import zlib
from collections import Counter, defaultdict

import numpy as np

from tickloom.llm import sharding
from tickloom.llm.queries import op8_sharding, table

SF = "/root/testdata/sf0.001"


def _check(docs, rows, shards):
    texts = {d.doc_id: d.text or "" for d in docs}
    assert Counter(r.doc_id for r in rows) == Counter(d.doc_id for d in docs)
    place, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        place[raw].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
        assert 0 <= r.shard < shards
    assert all(len(s) == 1 for s in place.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def test_query(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    rows = op8_sharding(spark, SF).collect()
    loads = _check(docs, rows, 24)
    groups = Counter()
    for d in docs:
        groups[d.text] += len((d.text or "").encode()) + 8
    fair = sum(groups.values()) / 24
    assert max(loads.values()) <= max(fair * 4 / 3, max(groups.values()))


def test_edge_cases(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "a", 1), (4, "a", 1), (5, "b" * 9000, 2), (5, "b" * 9000, 2), (7, "é\n", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    _check(docs.collect(), sharding.shard_documents(docs, 3).collect(), 3)
    assert sharding.shard_documents(docs.limit(0), 3).count() == 0


def test_allot_equals_the_plain_heap():
    import heapq

    rng = np.random.default_rng(0)
    classes = [(c, 1, int(c)) for c in np.unique(rng.integers(1, 5000, 200))]
    loads = [(0, s) for s in range(7)]
    expected = Counter()
    for c, _, b in sorted(classes, reverse=True):
        load, s = heapq.heappop(loads)
        heapq.heappush(loads, (load + b, s))
        expected[s] += b
    got = Counter()
    for c, first, end, s in sharding.allot(classes, 7):
        got[s] += (end - first) * c
    assert got == expected


def test_large_classes_are_levelled():
    runs = sharding.allot([(900, 10, 50_000), (10, 1_000_000, 10_000_000), (3, 7, 21)], 24)
    loads, seen = Counter(), Counter()
    for c, first, end, s in runs:
        loads[s] += (end - first) * {900: 5000, 10: 10, 3: 3}[c]
        seen[c] += end - first
    assert seen == {900: 10, 10: 1_000_000, 3: 7}
    assert max(loads.values()) - min(loads.values()) <= 10


def test_size_classes_are_ordered_and_narrow(spark):
    sizes = sorted({*range(1, 2000), *(3**k for k in range(30)), 2**40, 2**40 + 1})
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    rows = df.select("s", sharding.size_class(df.s).alias("c")).orderBy("s").collect()
    assert [r.c for r in rows] == sorted(r.c for r in rows)
    groups = defaultdict(list)
    for r in rows:
        groups[r.c].append(r.s)
    assert all(max(g) < min(g) * (1 + 1 / 256) for g in groups.values())
    assert max(groups) < sharding.MAX_CLASSES
