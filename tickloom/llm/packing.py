"""Packing of documents into token sequences by non-negative least squares.

A document's ids are cut into full windows, which are sequences of their own, and
one shorter rest. Only the histogram of the rests' lengths (one bin per length
below the window) goes to the driver. There, combinations of up to three lengths
that fill a window (or lengths that need no padding alone) are the columns of a
non-negative least-squares problem against the histogram. Its solution, rounded
down to what is there, says how often each combination is used; what remains is
packed greedily, the longest first. The plan has at most one row per length of
each combination, whatever the number of documents. Tasks look up a rest's
sequence by its number within its length.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import fields
from tickloom.llm.ranks import numbered

SWEEPS = 6


def byte_tokenizer(json_path: str, ranks_path: str, pattern: str):
    """text -> uint32 ids, equal to the tokenizers library with the file at ``json_path``.

    The rank file holds the same vocabulary for tiktoken, which is five times as
    fast. Texts with characters above U+024F, where the two libraries' Unicode
    tables may differ, and texts that tiktoken refuses go through tokenizers.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(json_path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {t["content"]: t["id"] for t in added}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    slow = Tokenizer.from_file(json_path)
    slow.no_truncation()
    slow.no_padding()

    def encode(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        if not len(raw) or raw.max() < 0xC9:
            try:
                return fast.encode_to_numpy(text, allowed_special="all")
            except Exception:  # tiktoken's pattern engine gives up on some very long runs
                pass
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


@dataclass
class Plan:
    """Runs of equal use: pieces number[i] <= n < number[i + 1] of a length."""

    keys: np.ndarray  # length << 40 | first number
    sequences: np.ndarray  # sequence of the first number
    offsets: np.ndarray
    total: int


def combinations(histogram: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Lengths in use that fill a window, or a power of two alone; up to three of them."""
    used = histogram > 0
    lengths = np.flatnonzero(used)
    single = [(int(a),) for a in lengths if a & (a - 1) == 0]
    pairs = [(int(a), int(window - a)) for a in lengths if 2 * a <= window and used[window - a]]
    triples = []
    for a in lengths[lengths * 3 <= window]:
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        c = window - a - b
        triples += [(int(a), int(x), int(y)) for x, y in zip(b[used[c]], c[used[c]], strict=True)]
    return single + pairs + triples


def repeat_counts(columns: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares by coordinate descent: sum of columns against the histogram.

    Each step solves for one count exactly; earlier columns take what they can, so
    the solution stays sparse and shallow combinations come first.
    """
    rest = histogram.astype(float).tolist()
    x = [0.0] * len(columns)
    for _ in range(SWEEPS):
        moved = 0.0
        for j, column in enumerate(columns):
            if len(column) == 1:
                gain = rest[column[0]]
            elif len(set(column)) == len(column):
                gain = sum([rest[a] for a in column]) / len(column)
            else:
                norm = sum(column.count(a) ** 2 for a in set(column))
                gain = sum([rest[a] for a in column]) / norm
            step = max(gain, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for a in column:
                    rest[a] -= step
        if moved < 0.5:
            break
    return np.array(x)


def plan(histogram: np.ndarray, window: int, first_sequence: int = 0) -> Plan:
    """Sequences for all rests; ``histogram[n]`` counts the rests of length n < window."""
    left = histogram.astype(np.int64).copy()
    patterns: list[tuple[tuple[int, ...], int]] = []
    columns = combinations(left, window)
    x = repeat_counts(columns, left)
    for j in np.argsort(-x, kind="stable"):
        if x[j] < 0.5:
            break
        column = columns[j]
        n = min(int(x[j] + 0.5), *(int(left[a]) // column.count(a) for a in column), 1 << 62)
        if n > 0:
            patterns.append((column, n))
            for a in column:
                left[a] -= n
    while left.any():
        space, parts, free = window, [], left.copy()
        while len(fits := np.flatnonzero(free[: space + 1])):
            parts.append(int(fits[-1]))
            free[fits[-1]] -= 1
            space -= int(fits[-1])
        n = min(int(left[a]) // parts.count(a) for a in set(parts))
        patterns.append((tuple(parts), n))
        for a in parts:
            left[a] -= n
    used = np.zeros(window + 1, np.int64)
    keys, sequences, offsets, sequence = [], [], [], first_sequence
    for parts, n in patterns:
        offset = 0
        for a in parts:
            keys.append((a << 40) | int(used[a]))
            sequences.append(sequence)
            offsets.append(offset)
            used[a] += n
            offset += a
        sequence += n
    order = np.argsort(np.array(keys, np.int64))
    pick = lambda v: np.array(v, np.int64)[order]
    return Plan(pick(keys), pick(sequences), pick(offsets), sequence)


def cut(
    docs: DataFrame, files: tuple[str, str, str], window: int = 1024, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Pieces of up to ``window`` ids: doc_id, start, length, ids_crc32, doc_tokens[, ids]."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
    if keep_ids:
        schema += ", ids array<int>"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_tokenizer(*files)
        for batch in fields.pieces(batches):
            rows, starts, lengths, checks, totals, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                own = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                raw = own.tobytes()
                for start in range(0, len(own), window):
                    part = raw[4 * start : 4 * (start + window)]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(len(part) // 4)
                    checks.append(zlib.crc32(part))
                    totals.append(len(own))
                    if keep_ids:
                        ids.append(own[start : start + window].astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(v, pa.int64()) for v in (starts, lengths, checks, totals)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(pieces, schema)


def pack(
    docs: DataFrame, files: tuple[str, str, str], window: int = 1024, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Adds sequence_id and offset to the pieces of ``cut``.

    ``files`` are the tokenizer's JSON file, its rank file and its split pattern. A
    null text is an empty one, whose only id is ``end_id``; very long texts are cut
    into many windows; repeated rows are packed each on its own; an empty table
    gives no rows; other columns are ignored.
    """
    pieces = numbered(
        cut(docs, files, window, end_id, id_col, text_col, keep_ids), "length", "piece"
    )
    sizes = {int(r[0]): r[1] for r in pieces.groupBy("length").count().collect()}
    histogram = np.array([sizes.get(n, 0) for n in range(window)], np.int64)
    rests = plan(histogram, window, sizes.get(window, 0))
    schema = pieces.drop("piece").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("piece").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            sequence, offset = number.copy(), np.zeros(len(number), np.int64)
            rest = length < window
            key = (length[rest] << 40) | number[rest]
            if len(key):
                run = np.searchsorted(rests.keys, key, "right") - 1
                sequence[rest] = rests.sequences[run] + key - rests.keys[run]
                offset[rest] = rests.offsets[run]
            names = [n for n in batch.schema.names if n != "piece"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return pieces.mapInArrow(place, schema)
