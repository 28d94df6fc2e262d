"""Near duplicates by a size-aware, heavy-light similarity join on shingle sets.

Two documents link when the Jaccard similarity of their sets reaches num / den.

*Light* sets, up to a size x, enumerate subsets of fixed size: for every size that a
partner may have, the overlap that a link needs is known, and the two sets link only
if they share a subset of just that size. Few elements may be missing, so these
subsets are few.

*Heavy* sets are found by scanning inverted lists. A list does not belong to one
shingle, which thousands of unrelated texts may share, but to the whole content of a
segment of the hash space. For sets of sizes up to ``hi`` at most
k = 2 hi (den - num) / (den + num) elements differ between linked sets, so of k + 1
segments one at least agrees; some more are added because segments may be empty. A
set with more empty segments than that also enters the lists of those.

The boundary x is chosen by cost: the number of entries that either way makes for the
sizes that occur.

Lists are read in order as streams and give each member's pair with the list's first
member. Where a list of more than two still holds several components, the members
outside the one that most belong to are compared with the rest, within the task and
block by block. Thus copies never meet all of each other as rows, and no link between
different components is missed. Documents with equal sets are one from the start.

Unrelated sets meet in a list by chance, when a passage that many texts share stands
alone in a segment. Such pairs grow faster than the documents, so no set travels for
them: pairs first meet on sketches, the parity of each of ``BITS`` bins of the set. A
differing element flips one bit, so sets whose sketches differ in more bits than
linked sets may differ in elements are no link. Sets of more than ``BITS`` elements
have a wide sketch besides, with a bit or two for each element. What remains is
checked against the exact sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import stars
from tickloom.llm.shingles import Shingler, mix
from tickloom.sources.tables import scratch_folder, staged

#: The largest size for which subsets are considered.
MOST_LIGHT = 48
#: Ids of documents to check are broadcast up to this many (16 MB), beyond that joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Bits of a sketch, and members of a list that are compared in one piece.
BITS = 1024
BLOCK = 4096


@dataclass(frozen=True)
class Rule:
    words: int
    num: int
    den: int

    def most(self, n: int) -> int:
        """The largest size that links with size n."""
        return n * self.den // self.num

    def overlap(self, n: int, m: int) -> int:
        """Common elements that sizes n and m need: num * union <= den * overlap."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def partners(self, n: int) -> range:
        return range(-(-n * self.num // self.den), self.most(n) + 1)

    def levels(self, largest: int) -> list[int]:
        """First sizes of groups; sizes that link lie in the same group or in neighbours."""
        firsts = [1]
        while firsts[-1] <= largest:
            firsts.append(self.most(firsts[-1]) + 1)
        return firsts

    def segments(self, hi: int) -> tuple[int, int]:
        """Number of segments for sizes up to hi, and how many of them may be empty."""
        k = 2 * hi * (self.den - self.num) // (self.den + self.num)
        spare = 6 + k // 12
        return k + 1 + spare, spare

    def subsets(self, n: int) -> int:
        """Entries of a light set of size n."""
        return sum(math.comb(n, self.overlap(n, m)) for m in self.partners(n) if self.overlap(n, m) <= n)

    def lists(self, n: int) -> int:
        """Entries of a heavy set of size n, of both its levels."""
        firsts = self.levels(n)
        own = self.most(firsts[-2])
        return self.segments(own)[0] + self.segments(self.most(own + 1))[0]


def boundary(rule: Rule, sizes: dict[int, int]) -> int:
    """The x with the fewest entries; ``sizes`` has the sets of each size up to ``MOST_LIGHT``."""
    def cost(x: int) -> int:
        light = sum(c * rule.subsets(n) for n, c in sizes.items() if n <= x)
        return light + sum(c * rule.lists(n) for n, c in sizes.items() if n >= least_heavy(rule, x))

    return min(range(MOST_LIGHT + 1), key=cost)


def least_heavy(rule: Rule, x: int) -> int:
    """The smallest size that may link with one above x."""
    return rule.partners(x + 1)[0]


def _left_out(n: int, d: int) -> np.ndarray:
    return np.array(list(combinations(range(n), d)), np.int64).reshape(math.comb(n, d), d)


def light_keys(rule: Rule, hashes: np.ndarray, left_out: dict[tuple[int, int], np.ndarray]) -> np.ndarray:
    """One key for each subset that a partner of some size would share.

    ``left_out`` keeps the places that subsets of a set of some size leave out.
    """
    n, spread = len(hashes), mix(hashes ^ np.uint64(0x5BD1E995))
    total = spread.sum(dtype=np.uint64)
    out = []
    for m in rule.partners(n):
        missing = n - rule.overlap(n, m)
        if missing < 0:
            continue
        if (n, missing) not in left_out:
            left_out[n, missing] = _left_out(n, missing)
        sums = total - spread[left_out[n, missing]].sum(axis=1, dtype=np.uint64)
        out.append(mix(sums + np.uint64(min(n, m) << 32 | max(n, m))))
    return np.concatenate(out) if out else hashes[:0]


def heavy_keys(rule: Rule, firsts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, upper: int):
    """(row, key) for one of the two levels of each set: its own group (0) or the next (1).

    Sets lie one after another, each sorted, so that a segment is a stretch of a set.
    """
    level = np.searchsorted(firsts, sizes, "right") - 1 + upper
    shape = [rule.segments(rule.most(int(f))) for f in firsts]
    parts = np.array([s for s, _ in shape], np.uint64)[level]
    spare = np.array([e for _, e in shape])[level]
    row = np.repeat(np.arange(len(sizes)), sizes)
    segment = ((hashes >> np.uint64(32)) * parts[row]) >> np.uint64(32)
    new = np.ones(len(hashes), bool)
    new[1:] = (row[1:] != row[:-1]) | (segment[1:] != segment[:-1])
    starts = np.flatnonzero(new)
    spread = mix(hashes ^ np.uint64(0x1B873593))
    sums = np.add.reduceat(spread, starts) if len(starts) else spread[:0]
    owner = row[starts]
    tag = lambda seg, lev: mix((lev.astype(np.uint64) << np.uint64(32)) + seg + np.uint64(1 << 62))
    owners, keys = [owner], [mix(sums ^ tag(segment[starts], level[owner]))]
    filled = np.bincount(owner, minlength=len(sizes))
    for i in np.flatnonzero(parts.astype(np.int64) - filled > spare):
        empty = np.setdiff1d(np.arange(int(parts[i]), dtype=np.uint64), segment[starts[owner == i]])
        owners.append(np.full(len(empty), i))
        keys.append(tag(empty, np.full(len(empty), level[i])))
    return np.concatenate(owners), np.concatenate(keys)


def sketches(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of BITS / 8 bytes: whether an odd number of the set's elements falls into each bin."""
    out = np.empty((len(ends) - 1, BITS // 8), np.uint8)
    for i in range(len(out)):
        out[i] = _parity(hashes[ends[i] : ends[i + 1]], BITS)
    return out


def _parity(hashes: np.ndarray, bits: int) -> np.ndarray:
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1)


def wide_sketches(hashes: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    """Sketches with the next power of two from the set's size on as bits; none for sets of up to ``BITS``."""
    bits = [1 << (n - 1).bit_length() if n > BITS else 0 for n in np.diff(ends).tolist()]
    return [_parity(hashes[ends[i] : ends[i + 1]], b).tobytes() if b else None for i, b in enumerate(bits)]


def signatures(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, two independent sums over the set, which stand for the set, and its sketches."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())]
        + [("sketch", pa.binary()), ("wide", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rule.words)
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for at, ends, hashes in shingler.sets(batch.column(1)):
                sums = [_row_sums(mix(hashes ^ np.uint64(salt)), ends) for salt in (0x9E3779B9, 0x85EBCA6B)]
                columns = [ids.slice(at, len(ends) - 1), pa.array(np.diff(ends))]
                columns += [pa.array(s.view(np.int64)) for s in sums]
                columns.append(pa.array([row.tobytes() for row in sketches(hashes, ends)], pa.binary()))
                columns.append(pa.array(wide_sketches(hashes, ends), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, sketch binary, wide binary")


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.r_[np.uint64(0), np.cumsum(values, dtype=np.uint64)]
    return total[ends[1:]] - total[ends[:-1]]


def entries(docs: DataFrame, rule: Rule, x: int, id_col: str, text_col: str) -> DataFrame:
    """(key, doc_id) of all lists."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])
    low = least_heavy(rule, x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, left_out = Shingler(rule.words), {}
        for batch in batches:
            all_ids = np.asarray(batch.column(0).cast(pa.int64()))
            for at, ends, hashes in shingler.sets(batch.column(1)):
                sizes = np.diff(ends)
                ids = all_ids[at : at + len(sizes)]
                for i in np.flatnonzero((sizes > 0) & (sizes <= x)):
                    keys = light_keys(rule, hashes[ends[i] : ends[i + 1]], left_out)
                    yield _entry_batch(keys, np.full(len(keys), ids[i]), schema)
                heavy = sizes >= max(low, 1)
                if heavy.any():
                    firsts = np.array(rule.levels(rule.most(int(sizes.max())) + 1))
                    some = hashes[np.repeat(heavy, sizes)]
                    for upper in (0, 1):
                        owner, keys = heavy_keys(rule, firsts, sizes[heavy], some, upper)
                        yield _entry_batch(keys, ids[heavy][owner], schema)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(run, "key long, doc_id long")


def _entry_batch(keys: np.ndarray, ids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids)], schema=schema)


def scan_lists(found: DataFrame) -> DataFrame:
    """(key, doc_id, first) for all lists of two or more, ``first`` being the smallest member."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A list's single row so far waits in ``held``; ``open_`` is the list that goes on, already given out.
        held: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        open_: tuple[int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = (np.r_[h, np.asarray(c)] for h, c in zip(held, batch.columns, strict=True))
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            counts = np.diff(np.r_[starts, len(keys)])
            firsts, many = ids[starts], counts > 1
            if open_ is not None and keys[0] == open_[0]:
                firsts, many[0] = firsts.copy(), True
                firsts[0] = open_[1]
            held = (keys[-1:], ids[-1:]) if not many[-1] else (keys[:0], ids[:0])
            open_ = (int(keys[-1]), int(firsts[-1])) if many[-1] else None
            keep = np.repeat(many, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[keep]), pa.array(ids[keep]), pa.array(np.repeat(firsts, counts)[keep])], schema=schema
            )

    ordered = found.repartition("key").sortWithinPartitions("key", "doc_id")
    return ordered.mapInArrow(run, "key long, doc_id long, first long")


def _differ(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which each row of one array of 64-bit words differs from each row of the other."""
    out = np.zeros((len(left), len(right)), np.int32)
    for a, b in zip(left.T, right.T, strict=True):
        out += np.bitwise_count(a[:, None] ^ b[None, :])
    return out


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """The sketches with ``width`` bytes that the same sets have; a bin takes those that lie whole widths after it."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1)


def likely(pairs: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link. ``reps`` has rep, n, sketch and wide."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ("sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b = (batch.column(c).to_numpy() for c in ("a", "b", "n_a", "n_b"))
            own = [batch.column(c).to_pylist() for c in names]
            lengths = np.array([[len(x) for x in side] for side in own], np.int64).reshape(2, len(a))
            keep = np.zeros(len(a), bool)
            for both in np.unique(lengths, axis=1).T:
                rows = np.flatnonzero((lengths == both[:, None]).all(axis=0))
                left, right = (
                    _folded(np.frombuffer(b"".join([side[i] for i in rows]), np.uint8).reshape(len(rows), n), both.min())
                    for side, n in zip(own, both, strict=True)
                )
                differ = np.bitwise_count((left ^ right).view(np.uint64)).sum(axis=1, dtype=np.int64)
                keep[rows] = (rule.den + rule.num) * differ <= (rule.den - rule.num) * (n_a[rows] + n_b[rows])
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], schema=schema)

    side = lambda c: reps.select(
        F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.coalesce("wide", "sketch").alias(f"sketch_{c}")
    )
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(_compatible(rule, "n_a", "n_b"))
    return both.select("a", "b", "n_a", "n_b", *names).mapInArrow(run, "a long, b long").distinct()


def compare_lists(listed: DataFrame, rule: Rule, reps: DataFrame | None = None) -> DataFrame:
    """Pairs (a > b) of members of a list in different components whose sketches allow a link.

    ``listed`` has key, rep, n, root, main (the root of most members) and sketch; with
    ``reps``, a table of rep, n and sketch, those two are joined once the members are
    dealt out, so they are shuffled once. The lesser members, those of other roots, and the rest are cut into blocks of about
    ``BLOCK``. Lesser blocks meet each other and the blocks of the rest, which do not
    meet among themselves: rows grow with lesser members times blocks, no task holds
    more than two blocks of a list, and a long list is shared by many.
    """
    lesser = F.col("root") != F.col("main")
    count = lambda mask: F.ceil(F.count(F.when(mask, 1)) / BLOCK)
    sizes = listed.groupBy("key").agg(count(lesser).alias("_few"), count(~lesser).alias("_rest"))
    dealt = listed.join(sizes, "key").withColumn("_lesser", lesser)
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("_lesser"), F.col("_few")).otherwise(F.col("_rest")))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    pair = lambda kind, i, j: F.struct(F.lit(kind).cast("long").alias("kind"), i.alias("i"), j.alias("j"))
    # Kind 0: two lesser blocks; kind 1: a lesser block and one of the rest; kind 2: a list of no more than these two.
    few = F.transform(upto("_few"), lambda k: pair(0, F.least(k, F.col("_own")), F.greatest(k, F.col("_own"))))
    across = F.transform(upto("_rest"), lambda k: pair(1, F.col("_own"), k))
    back = F.transform(upto("_few"), lambda k: pair(1, k, F.col("_own")))
    both = F.array(pair(2, F.lit(0).cast("long"), F.lit(0).cast("long")))
    short = (F.col("_few") <= 1) & (F.col("_rest") <= 1)
    tags = F.explode(F.when(short, both).when(F.col("_lesser"), F.concat(few, across)).otherwise(back))
    dealt = dealt.withColumn("_own", own).withColumn("_tag", tags).select(
        "key", F.col("_tag.kind").alias("_kind"), F.col("_tag.i").alias("_i"), F.col("_tag.j").alias("_j"), "_own", "_lesser",
        "rep", "root", *(() if reps is not None else ("n", "sketch")),
    )
    if reps is not None:
        dealt = dealt.join(reps.select("rep", "n", "sketch"), "rep")
    dealt = dealt.select("key", "_kind", "_i", "_j", "_own", "_lesser", "rep", "n", "root", "sketch")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows: pa.Table) -> pa.RecordBatch:
        rep, n, root = (rows.column(c).to_numpy() for c in ("rep", "n", "root"))
        words = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(len(rep), -1)
        found = [np.zeros((2, 0), np.int64)]
        kind, i, j = (rows.column(c)[0].as_py() for c in ("_kind", "_i", "_j"))
        lesser = rows.column("_lesser").to_numpy()
        own = rows.column("_own").to_numpy() == i
        every = np.ones(len(rep), bool)
        sides = {0: [(own, own if i == j else ~own)], 1: [(lesser, ~lesser)], 2: [(lesser, every)]}[kind]
        for left, right in sides:
            left, right = np.flatnonzero(left), np.flatnonzero(right)
            for at in range(0, len(left), 256):
                a, b = left[at : at + 256], right
                most = (rule.den - rule.num) * (n[a][:, None] + n[b][None, :]) // (rule.den + rule.num)
                fits = (_differ(words[a], words[b]) <= most) & (root[a][:, None] != root[b][None, :])
                small, large = np.minimum(n[a][:, None], n[b][None, :]), np.maximum(n[a][:, None], n[b][None, :])
                i, j = np.nonzero(fits & (rule.den * small >= rule.num * large))
                found.append(np.stack([rep[a[i]], rep[b[j]]]))
        pairs = np.concatenate(found, axis=1)
        pairs = np.unique(np.stack([pairs.max(axis=0), pairs.min(axis=0)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            tags = np.stack([batch.column(c).to_numpy() for c in range(4)], axis=1)
            cuts = np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1
            for a, b in zip(np.r_[0, cuts].tolist(), [*cuts.tolist(), len(tags)], strict=True):
                tag = tuple(tags[a].tolist())
                if held and tag != now:
                    yield links(pa.Table.from_batches(held))
                    held = []
                now = tag
                held.append(batch.slice(a, b - a))
        if held:
            yield links(pa.Table.from_batches(held))

    ordered = dealt.repartition("key", "_kind", "_i", "_j").sortWithinPartitions("key", "_kind", "_i", "_j")
    return ordered.mapInArrow(run, "a long, b long")


def _sets_of(docs: DataFrame, wanted: DataFrame, rule: Rule, id_col: str, text_col: str, folder: str) -> DataFrame:
    """doc_id and the sorted set of the wanted documents, written below ``folder``."""
    schema = pa.schema([("doc_id", pa.int64()), ("own", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(rule.words)
        for batch in batches:
            for at, ends, hashes in shingler.sets(batch.column(1)):
                own = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ends) - 1), own], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    some = rows.join(_bounded(wanted), "doc_id", "left_semi")
    return staged(some.mapInArrow(run, "doc_id long, own array<bigint>"), "sets", folder)


def checked(pairs: DataFrame, docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) that link; ids with several rows may repeat some. ``pairs`` is a written table.

    The sets are deleted once the links are written. Those are not made distinct here: that would hold the
    rows of one b together, while a join alone can be split.
    """
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    wanted = staged(wanted, "jaccard-wanted")
    with scratch_folder(docs.sparkSession, "jaccard") as folder:
        sets = _sets_of(docs, wanted, rule, id_col, text_col, folder)
        side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("own").alias(f"own_{c}"))
        both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        common = F.size(F.array_intersect("own_a", "own_b"))
        union = F.size("own_a") + F.size("own_b") - common
        linked = both.where(rule.den * common.cast("long") >= rule.num * union.cast("long"))
        return staged(linked.select("a", "b"), "jaccard-links")


def _compatible(rule: Rule, n: str, m: str):
    return rule.den * F.least(n, m) >= rule.num * F.greatest(n, m)


def components(
    docs: DataFrame, words: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of every row.

    Ids are integers. A null or empty text, or one without words, has an empty set and
    links with nothing; one with fewer words than a shingle has its whole sequence as
    its only shingle. Very long texts are read whole. Rows that repeat an id are one
    document, which has the links of all of them; a row with a null id takes no part
    and has a null component. An empty table gives no rows; other columns are ignored.
    """
    rule = Rule(words, num, den)
    rows = staged(signatures(docs, rule, id_col, text_col), "jaccard-signatures")
    named = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = named.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    members = staged(named.join(classes, ["n", "s1", "s2"]).select("doc_id", "n", "rep", "sketch", "wide"), "jaccard-classes")
    sizes = {r["n"]: r["count"] for r in rows.where(F.col("n").between(1, MOST_LIGHT)).groupBy("n").count().collect()}
    x = boundary(rule, sizes)
    of_id = members.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("other"))
    of_id = staged(of_id, "jaccard-ids")
    # An id whose rows differ may represent several classes: it has a size and sketches for each.
    reps = members.where("doc_id = rep").select("rep", "n", "sketch", "wide").distinct()
    reps = staged(reps, "jaccard-reps")
    copies = of_id.join(reps, of_id.doc_id == reps.rep, "left_anti").select(F.col("doc_id").alias(id_col))
    texts = docs.where(F.col(id_col).isNotNull()).select(id_col, text_col)
    texts = texts.join(_bounded(staged(copies, "jaccard-copies")), id_col, "left_anti")
    lists = staged(scan_lists(entries(texts, rule, x, id_col, text_col)), "jaccard-lists")

    # Each member with its list's first.
    spokes = lists.select(F.col("doc_id").alias("a"), F.col("first").alias("b")).where("a <> b").distinct()
    spokes = staged(likely(spokes, reps, rule), "jaccard-pairs")
    several = of_id.where("rep <> other").select("doc_id", F.col("rep").alias("a"))
    same_id = several.join(members.select("doc_id", F.col("rep").alias("b")), "doc_id").where("a <> b")
    same_id = same_id.select("a", "b").distinct()
    links = checked(spokes, docs, rule, id_col, text_col).unionByName(same_id)
    found = stars(links)

    # Lists that still hold several components: their lesser members against the rest. The two of a list of two
    # have met above.
    rooted = reps.select("rep").distinct().join(found.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left")
    rooted = staged(rooted.select("rep", F.coalesce("root", "rep").alias("root")), "jaccard-roots")
    root = lists.select("key", F.col("doc_id").alias("rep")).join(rooted, "rep")
    tallies = root.groupBy("key", "root").count()
    most = tallies.groupBy("key").agg(
        F.max(F.struct("count", "root")).getField("root").alias("main"), F.count(F.lit(1)).alias("roots"),
        F.sum("count").alias("entries"),
    ).where("roots > 1 AND entries > 2")
    listed = staged(root.join(most.select("key", "main"), "key").select("key", "main", "rep", "root"), "jaccard-mixed")
    more = compare_lists(listed, rule, reps).distinct().join(spokes, ["a", "b"], "left_anti")
    more = staged(likely(more, reps, rule), "jaccard-more")
    if not more.isEmpty():
        found = stars(links.unionByName(checked(more, docs, rule, id_col, text_col)))

    final = of_id.join(found.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left")
    final = final.select("doc_id", F.coalesce("root", "rep").alias("component_id"))
    return rows.join(final, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _bounded(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it is small enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def first_of_each(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with their columns.

    Documents without words and rows with a null id stay.
    """
    found = components(docs, words, num, den, id_col, text_col).where("doc_id <> component_id")
    gone = staged(found.select(F.col("doc_id").alias(id_col)).distinct(), "jaccard-gone")
    return docs.join(_bounded(gone), id_col, "left_anti").select(*docs.columns)
