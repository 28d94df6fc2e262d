"""Byte-pair encoding as a streaming transducer with bounded lookahead.

``sufficient_lookahead`` reads off the merge list how many bytes to the right can
still change a token. A word is read in pieces: what has been read is merged, the
tokens that end at least that many bytes before the end of the buffer are final and
are emitted, and the rest waits for more. Tokens of a merged stretch are the
merges of their own bytes, so the rest can be merged again by itself. The buffer,
the cache of short words and the hashes are all that is kept, however long a text.

Decoding is a state machine as well: ids come in one by one, text goes out as soon
as its bytes are complete.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import fields

#: Words up to this many bytes are merged together and cached; of the two halves
#: of the cache, each of up to this many words, the older one goes when the other is full.
SHORT_WORD = 48
CACHE_WORDS = 150_000
#: Words that are looked up together.
SLICE = 200_000
#: Characters normalised at a time; cut before white space.
CHUNK = 1 << 16
_ID_BITS = 20
_MASK = (1 << _ID_BITS) - 1

# White space as the tokenizer file's pattern engine has it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def sufficient_lookahead(rules: list[tuple[int, int, int]], length: Callable[[int], int]) -> int:
    """Bytes after which the right context no longer changes a token.

    ``rules`` are (left, right, result) in order of priority. Merge by merge, let the
    frontier be the place left of which the tokens are the same whatever follows. A
    merge moves it left only over the last token before it, which must be the merge's
    left part, while the token after it is the right part. That token begins at the
    place where the frontier stopped before, so the left part of the earlier merge is
    the right part itself or begins it. The bound is the longest such chain, with its
    left parts added up. Raises if a merge uses a token that only a later one makes.
    """
    made: dict[int, list[tuple[int, int]]] = {}
    begins: dict[int, frozenset[int]] = {}
    reach: dict[int, int] = {}
    results = {result for _, _, result in rules}
    best = 0

    def spine(token: int) -> frozenset[int]:
        if token not in begins:
            begins[token] = frozenset({token}).union(*(spine(left) for left, _ in made.get(token, [])))
        return begins[token]

    for left, right, result in rules:
        if any(part in results and part not in made for part in (left, right)):
            raise ValueError("a merge uses a token before it is made")
        chain = length(left) + max((reach.get(t, 0) for t in spine(right)), default=0)
        reach[left] = max(reach.get(left, 0), chain)
        best = max(best, chain)
        made.setdefault(result, []).append((left, right))
        begins.pop(result, None)
    return best


class _PairTable:
    """Pairs to rank and result, for whole arrays: open addressing with linear probing."""

    NONE = np.int64(1 << 62)

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        bits = max(4, (4 * len(merges)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, self.NONE, np.int64)
        pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            pairs.setdefault(vocab[a] << _ID_BITS | vocab[b], rank << _ID_BITS | vocab[a + b])
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            # Of those that meet in a free place the first stays, the others go one further.
            _, first = np.unique(slots, return_index=True)
            first = first[self.keys[slots[first]] < 0]
            self.keys[slots[first]], self.values[slots[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << bits | result of each pair, ``NONE`` where there is no merge."""
        keys = left << _ID_BITS | right
        slots = self._slots(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.values[slots], self.NONE)
        open_ = np.nonzero((there != keys) & (there >= 0))
        while len(open_[0]):
            slots[open_] = (slots[open_] + 1) & self.mask
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            out[tuple(i[hit] for i in open_)] = self.values[slots[tuple(i[hit] for i in open_)]]
            open_ = tuple(i[~hit & (there >= 0)] for i in open_)
        return out


class Transducer:
    """Words (as bytes) to ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        alphabet = byte_alphabet()
        self.table = _PairTable(vocab, merges)
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + suffix] for c in alphabet]
        self.merges: dict[int, int] = {}
        rules = []
        for rank, (a, b) in enumerate(merges):
            left, right, result = vocab[a], vocab[b], vocab[a + b]
            self.merges.setdefault(left << _ID_BITS | right, rank << _ID_BITS | result)
            rules.append((left, right, result))
        self._rules = rules
        self.size = {i: len(t.removesuffix(suffix)) if suffix else len(t) for t, i in vocab.items()}

    @cached_property
    def lookahead(self) -> int:
        return sufficient_lookahead(self._rules, self.size.__getitem__)

    def merged(self, ids: list[int]) -> list[int]:
        """All merges of one stretch, in order of priority, each from left to right."""
        find, none = self.merges.get, 1 << 62
        while len(ids) > 1:
            pairs = [find(a << _ID_BITS | b, none) for a, b in zip(ids, ids[1:], strict=False)]
            best = min(pairs)
            if best == none:
                break
            result = best & _MASK
            at = pairs.index(best)
            if pairs.count(best) == 1:
                ids[at : at + 2] = [result]
                continue
            out, end = ids[:at], len(pairs)
            while at < end:
                if pairs[at] == best:
                    out.append(result)
                    at += 2
                else:
                    out.append(ids[at])
                    at += 1
            ids = out + ids[at:]
        return ids

    def short_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of many words at once. Words of a length are the rows of a matrix; every round
        carries out the first merge of each row, so that all rows left are equally long."""
        out: list[list[int]] = [[] for _ in words]
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if w:
                by_length.setdefault(len(w), []).append(i)
        inner, last = np.array(self.inner), np.array(self.last)
        for length, own in by_length.items():
            rows = np.array(own)
            raw = np.frombuffer(b"".join([words[i] for i in own]), np.uint8).reshape(-1, length)
            ids = np.concatenate([inner[raw[:, :-1]], last[raw[:, -1:]]], axis=1)
            ranks = self.table.find(ids[:, :-1], ids[:, 1:])
            while True:
                at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
                best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _PairTable.NONE)
                done = best == _PairTable.NONE
                if done.any():
                    for i, found in zip(rows[done].tolist(), ids[done].tolist(), strict=True):
                        out[i] = found
                    go = ~done
                    rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                if not len(rows):
                    break
                line = np.arange(len(rows))
                ids[line, at] = best & _MASK
                place = np.arange(ids.shape[1] - 1)
                ids = np.take_along_axis(ids, place + (place > at[:, None]), axis=1)
                place = place[:-1]
                ranks = np.take_along_axis(ranks, place + (place >= at[:, None]), axis=1)
                for near in (at - 1, at):
                    inside = (near >= 0) & (near < ranks.shape[1])
                    i, j = line[inside], near[inside]
                    ranks[i, j] = self.table.find(ids[i, j], ids[i, j + 1])
        return out

    def word(self, raw: bytes) -> Iterator[int]:
        """Ids of one word. Long words are streamed with a buffer of a few lookaheads."""
        if not raw:
            return
        inner, at, size = self.inner, 0, 4 * self.lookahead + 64 if len(raw) > SHORT_WORD else len(raw)
        while len(raw) - at > size:
            done, final = 0, size - self.lookahead
            for token in self.merged([inner[b] for b in raw[at : at + size]]):
                done += self.size[token]
                if done > final:
                    done -= self.size[token]
                    break
                yield token
            at += done
        rest = [inner[b] for b in raw[at:-1]]
        yield from self.merged([*rest, self.last[raw[-1]]])


class Decoder:
    """Ids to text, one by one. Without a decoder the tokens are joined by spaces, as the library does."""

    def __init__(self, tokens: dict[int, str], kind: str | None, special: set[int] = frozenset()):
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"no decoder of type {kind}")
        self.tokens, self.kind, self.special, self.first = tokens, kind, special, True
        self.bytes = {c: b for b, c in enumerate(byte_alphabet())}
        self.pending = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        text = self.tokens[token]
        if self.kind is None:
            out = text if self.first else " " + text
            self.first = False
            return out
        raw = text.encode() if token in self.special else bytes(self.bytes[c] for c in text)
        return self.pending.decode(raw)

    def end(self) -> str:
        return self.pending.decode(b"", True) if self.kind else ""


class Tokenizer:
    """A tokenizer file: special tokens, normalisation, words, merges, decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split.get("behavior") != "Removed":
            raise ValueError("this tokenizer file has another normalisation or split")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.decoder = (spec["decoder"] or {}).get("type")
        longest_first = sorted(self.added, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self._latin = re.compile(
            f"{_CONTRACTION}|[{_LETTER}]+|[{_NUMBER}]|[^{SPACE}{_LETTER}{_NUMBER}]+"
        )
        self._space = re.compile("[ \t\n\r]")

    @cached_property
    def _any(self):
        import regex

        return regex.compile(rf"{_CONTRACTION}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")

    def words(self, text: str) -> Iterator[list[str] | int]:
        """Lists of words, and the ids of special tokens between them."""
        for i, part in enumerate(self._special.split(text) if self._special else [text]):
            if i % 2:
                yield self.added[part]
                continue
            at = 0
            while at < len(part):
                cut = self._space.search(part, at + CHUNK) if len(part) - at > CHUNK else None
                end = cut.start() if cut else len(part)
                yield self._split(part[at:end])
                at = end

    def _split(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            # Each character by itself: Python's own rule for a sigma that ends a word is left out.
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        chunk = chunk.lower()
        try:
            chunk.encode("latin-1")
        except UnicodeEncodeError:
            return self._any.findall(chunk)
        return self._latin.findall(chunk)

    def encode(self, text: str) -> Iterator[int]:
        for part in self.words(text):
            if isinstance(part, int):
                yield part
            else:
                for word in part:
                    yield from self.transducer.word(word.encode())

    def decode(self, ids) -> str:
        machine = Decoder(self.tokens, self.decoder, set(self.added.values()))
        return "".join([*map(machine.feed, ids), machine.end()])


class _State:
    """What is kept of a text while it is read."""

    __slots__ = ("n", "ids", "decoded")

    def __init__(self):
        self.n, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()


class Digester:
    """Texts to (number of ids, hash of the ids, hash of the decoded text).

    Texts are read in chunks. The words of about ``SLICE`` characters, of one text or
    of several, are looked up together; those not in the cache are merged together.
    The cache has word -> (number of ids, ids as text, decoded text).
    """

    def __init__(self, tokenizer: Tokenizer):
        if tokenizer.decoder:
            raise ValueError("digests are for files without a decoder")
        self.tokenizer, self.cache, self.older = tokenizer, {}, {}
        self.numbers = {i: str(i) for i in tokenizer.tokens}

    def _texts(self, ids: list[int]) -> tuple[str, str]:
        numbers, tokens = self.numbers, self.tokenizer.tokens
        return " ".join([numbers[i] for i in ids]), " ".join([tokens[i] for i in ids])

    def __call__(self, texts: list[str]) -> list[tuple[int, str, str]]:
        states, waiting, size = [], [], 0
        for text in texts:
            states.append(_State())
            for part in self.tokenizer.words(text):
                waiting.append((states[-1], part))
                size += 1 if isinstance(part, int) else len(part)
                if size >= SLICE:
                    self._flush(waiting)
                    waiting, size = [], 0
        self._flush(waiting)
        return [(s.n, s.ids.hexdigest(), s.decoded.hexdigest()) for s in states]

    def _flush(self, waiting: list[tuple[_State, list[str] | int]]) -> None:
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        words: set[str] = set()
        for _, part in waiting:
            if not isinstance(part, int):
                words.update(part)
        machine, cache, older = self.tokenizer.transducer, self.cache, self.older
        unknown = words - cache.keys()
        known = unknown & older.keys()
        cache.update({w: older[w] for w in known})
        new = [(w, w.encode()) for w in unknown - known]
        short = [(w, raw) for w, raw in new if len(raw) <= SHORT_WORD]
        for (w, _), ids in zip(short, machine.short_words([raw for _, raw in short]), strict=True):
            cache[w] = self._texts(ids)
        long = {w: self._texts(list(machine.word(raw))) for w, raw in new if len(raw) > SHORT_WORD}
        for state, part in waiting:
            if isinstance(part, int):
                found = [self._texts([part])]
            elif long:
                found = [cache.get(w) or long[w] for w in part]
            else:
                found = list(map(cache.__getitem__, part))
            if found:
                gap = " " if state.n else ""
                ids = gap + " ".join([f[0] for f in found])
                state.n += ids.count(" ") + (not gap)
                state.ids.update(ids.encode())
                state.decoded.update((gap + " ".join([f[1] for f in found])).encode())


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text.

    For files without a decoder, whose decoded words are joined by spaces. A null text
    is an empty one: no tokens and the hashes of the empty text. Texts of any length,
    also without white space, are streamed. Repeated rows are encoded each; an empty
    table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digester = Digester(Tokenizer(path))
        for batch in fields.pieces(batches):
            found = digester([t or "" for t in batch.column(1).to_pylist()])
            n, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and decoded: the tokens themselves. Cases as in ``digests``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(path)
        for batch in batches:
            ids = [list(tokenizer.encode(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(tokenizer.decode, ids), pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {id_type}, ids array<int>, decoded string"
    )
