import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm import bpe
from tickloom.llm.queries import op7_bpe, table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
EDGES = [
    "", " ", "It's  THE end.\n\tWe'll  see", "ΣΑΣ Σ όδος ΟΔΟΣ", "é É ẛ̣ İstanbul ǅ", "字字 12³ ½ 😀😀 ﬁ",
    "<|endoftext|>a<|startoftext|>", "<|endoftext|", "x" * 3000, "aAbBcC" * 900 + " end", "!?" * 2000, "\x85a　b\xa0c​d",
    "á" * 500, "1234567890" * 30, "\x1c\x1d\x00a",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_query_equals_the_library(spark, library):
    texts = {d.doc_id: d.text for d in table(spark, SF, "documents").collect()}
    rows = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op7_bpe(spark, SF).collect()}
    assert rows == {k: expected(library, t) for k, t in texts.items()}


def test_edge_cases(spark, library, own, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    monkeypatch.setattr(bpe, "SLICE", 7)
    digester = bpe.Digester(own)
    assert digester(EDGES + EDGES) == [expected(library, t) for t in EDGES] * 2
    for text in EDGES:
        assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
        assert digester([text]) == [expected(library, text)]
    rows = [(1, None, 0), (2, "a b", 0), (2, "a b", 0), (3, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted(tuple(r) for r in bpe.digests(df, PATH).collect())
    assert got == sorted((i, *expected(library, t)) for i, t, _ in rows)
    assert bpe.digests(df.limit(0), PATH).count() == 0
    for r in bpe.encode(df, PATH).collect():
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


def test_streaming_equals_merging_at_once(own):
    rng = random.Random(5)
    machine = own.transducer
    words = [w for w in ("the", "ing", "tion", "eau", "schaft", "ñ", "aaaa", "###", "…") for _ in range(3)]
    for _ in range(60):
        raw = "".join(rng.choice(words) for _ in range(rng.randint(60, 700))).encode()
        whole = machine.merged([*(machine.inner[b] for b in raw[:-1]), machine.last[raw[-1]]])
        assert list(machine.word(raw)) == whole
    assert 8 <= machine.lookahead < 4096


def test_many_short_words_at_once(own):
    rng = random.Random(6)
    words = ["".join(rng.choice("etaoinshrdlué😀ñ#1") for _ in range(rng.randint(0, 20))).encode() for _ in range(3000)]
    assert own.transducer.short_words(words) == [list(own.transducer.word(w)) for w in words]
    assert own.transducer.short_words([]) == []


def test_lookahead_of_small_merge_lists():
    size = {0: 1, 1: 1, 2: 2, 3: 3}.__getitem__
    assert bpe.sufficient_lookahead([(0, 1, 2)], size) == 1
    assert bpe.sufficient_lookahead([(0, 1, 2), (1, 2, 3)], size) == 2
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(2, 1, 3), (0, 1, 2)], size)


def test_incremental_decoder_of_bytes():
    alphabet = bpe.byte_alphabet()
    text = "aé字😀\n"
    tokens = {i: alphabet[b] for i, b in enumerate(text.encode())}
    machine = bpe.Decoder(tokens, "ByteLevel")
    out = [machine.feed(i) for i in tokens] + [machine.end()]
    assert "".join(out) == text and out[1] == ""
