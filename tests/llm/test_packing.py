"""Packing against a brute-force reading of the contract, and its plan."""

import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tickloom.llm import packing
from tickloom.llm.queries import op2_packing, table, tokenizer_files

SF = "/root/testdata/sf0.001"


def _ids(texts):
    tokenizer = Tokenizer.from_file(tokenizer_files()[0])
    return [[*e.ids, 0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def _check(rows, ids, window=1024):
    """Each id once, gapless offsets, windows respected; returns the padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for doc, own in ids.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            part = np.array(own[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(part))
            at += r.length
        assert at == len(own)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_query_packs_every_id_once_with_little_padding(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    ids = dict(zip([d.doc_id for d in docs], _ids([d.text for d in docs]), strict=True))
    rows = op2_packing(spark, SF).collect()
    padding = _check(rows, ids)
    assert padding < 0.02 * sum(map(len, ids.values()))


def test_edge_cases(spark):
    texts = {
        1: None, 2: "", 3: "a b c", 4: "a b c", 5: "word " * 5000, 6: "<|endoftext|>x", 7: "Ωμέγα 字 😀 \u0301",
        8: " " * 3000, 9: "x" * 5000,
    }
    rows = [(k, v, 0) for k, v in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long")
    got = packing.pack(docs, tokenizer_files(), window=64, keep_ids=True).collect()
    ids = dict(zip(texts, _ids(texts.values()), strict=True))
    _check(got, ids, 64)
    assert all(r.ids == ids[r.doc_id][r.start : r.start + r.length] for r in got)
    assert packing.pack(docs.limit(0), tokenizer_files()).count() == 0


def test_plan_uses_every_rest_once():
    rng = np.random.default_rng(1)
    histogram = np.zeros(256, np.int64)
    histogram[1:] = rng.integers(0, 40, 255)
    histogram[[2**k for k in range(8)]] = 0  # those stand alone without padding
    made = packing.plan(histogram, 256, 5)
    assert len(made.keys) == len(set(made.keys.tolist()))
    total = sum(int(n) * a for a, n in enumerate(histogram))
    assert total <= (made.total - 5) * 256 <= total * 1.05 + 256


def test_least_squares_reaches_an_exact_histogram():
    histogram = np.zeros(16, np.int64)
    for parts, n in (((3, 13), 7), ((5, 5, 6), 4)):
        for a in parts:
            histogram[a] += n
    made = packing.plan(histogram, 16)
    assert made.total == 11
