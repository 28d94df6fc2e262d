"""Line dedup by content-defined chunks of lines, with DataFrame functions only.

A rolling hash goes over the line hashes of every two neighbouring lines with text (and
the blank lines between them). A place whose rolling hash is not larger than that of a
neighbouring place is a boundary; its two lines are a chunk. Places whose lines have
fewer than ``LEAST`` characters together are none, those of ``MOST`` or more always one,
as other chunkers cut at a greatest size. Boundaries follow from the lines around them
alone, so a passage is cut alike wherever it stands; of any two neighbouring places at
least one is a boundary.

Chunks that occur more than once are found by their hash. A later one grows by the line
before and the line after it where those equal the first one's neighbours. The texts of
chunks, grown or not, are then compared byte by byte (grouping by the text), and all but
the first, in order of document and place, are removed. A run of three or more equal
lines thus goes from its first line to its last; one of two lines goes if its only
place is a boundary in both documents.

Counting and the search for the first one are aggregates that are merged within tasks
and written; a chunk that a third of all documents share meets other rows only in joins
with what was written, whose partitions Spark can split. The written chunks and their
first places, with their texts, are deleted once the lines to remove are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import fields
from tickloom.sources.tables import scratch_folder, staged

#: Fewest characters of a chunk's two lines, without space around them: lone brackets are no chunk.
LEAST = 24
#: From so many characters on a place is a boundary in any case: about fifty words.
MOST = 256
#: Place of a chunk as one number: document id times this plus the first line.
_LINES = 10_000_000_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once however often a lambda in the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The chunk at every boundary: _id, _start, _end (lines, both included) and _hash.

    _before and _after are the neighbouring lines with text, _prev and _next hashes of
    them and their distance; null where there is none.
    """
    own = F.transform(F.split(text_col, "\n", -1), lambda line, i: F.struct(
        i.alias("i"), F.xxhash64(line).alias("h"), F.length(F.regexp_replace(line, r"^\s+|\s+$", "")).alias("n")
    ))
    filled = F.filter(own, lambda c: c["n"] > 0)

    def places(own: Column) -> Column:
        def place(c: Column, k: Column) -> Column:
            back, second, ahead = F.get(own, k - 1), F.get(own, k + 1), F.get(own, k + 2)
            rolling = F.xxhash64(c["h"], second["h"], second["i"] - c["i"])
            return F.struct(
                c["i"].alias("s"), second["i"].alias("e"),
                F.when(c["n"] + second["n"] >= LEAST, rolling).alias("h"),
                (c["n"] + second["n"] >= MOST).alias("long"),
                back["i"].alias("b"), F.when(back.isNotNull(), F.hash(back["h"], c["i"] - back["i"])).alias("p"),
                ahead["i"].alias("a"), F.when(ahead.isNotNull(), F.hash(ahead["h"], ahead["i"] - second["i"])).alias("n"),
            )

        return F.transform(own, place)

    def boundaries(all_places: Column) -> Column:
        def is_one(c: Column, k: Column) -> Column:
            back, ahead = F.get(all_places, k - 1)["h"], F.get(all_places, k + 1)["h"]
            return c["long"] | (c["h"] <= back) | back.isNull() | (c["h"] <= ahead) | ahead.isNull()

        return F.filter(F.filter(all_places, lambda c, k: is_one(c, k) & c["h"].isNotNull()), lambda c: c["e"].isNotNull())

    cut = docs.where(F.col(text_col).contains("\n")).select(
        F.col(id_col).alias("_id"), F.explode(_let(_let(filled, places), boundaries)).alias("c")
    )
    names = {"s": "_start", "e": "_end", "h": "_hash", "b": "_before", "p": "_prev", "a": "_after", "n": "_next"}
    return cut.select("_id", *[F.col(f"c.{short}").alias(name) for short, name in names.items()])


def _place() -> Column:
    return (F.col("_id").cast("decimal(25,0)") * F.lit(_LINES).cast("decimal(11,0)") + F.col("_start")).cast(
        "decimal(38,0)"
    )


def _merged(spans: Column) -> Column:
    """Spans (struct s, e) of two to four lines with text as disjoint ranges in order."""
    def longest(own: Column) -> Column:
        return F.filter(own, lambda c, k: F.coalesce(F.get(own, k + 1)["s"] != c["s"], F.lit(True)))

    def reaching(own: Column) -> Column:
        # A span ends three lines with text after its start at most, so no more than three reach into a later one.
        ends = lambda c, k: F.greatest(c["e"], *[F.get(own, k - j)["e"] for j in (1, 2, 3)])
        return F.transform(own, lambda c, k: F.struct(c["s"].alias("s"), ends(c, k).alias("e")))

    def ranges(own: Column) -> Column:
        first = F.filter(own, lambda c, k: (k == 0) | (c["s"] > F.coalesce(F.get(own, k - 1)["e"], F.lit(-1))))
        last = F.filter(own, lambda c, k: F.coalesce(F.get(own, k + 1)["s"] > c["e"], F.lit(True)))
        return F.zip_with(first, last, lambda a, b: F.struct(a["s"].alias("s"), b["e"].alias("e")))

    return _let(_let(_let(F.array_sort(spans), longest), reaching), ranges)


def _variants(c: Column) -> Column:
    """The spans of a chunk whose texts are compared.

    The first one of its hash gives all it may be compared with, a later one its own
    two lines and, if it grows, all lines that seem to be equal.
    """
    back, ahead, start, end = c["_before"], c["_after"], c["_start"], c["_end"]
    span = lambda s, e: F.struct(s.alias("s"), e.alias("e"), c["_later"].alias("later"))
    grown = span(F.when(c["_back"], back).otherwise(start), F.when(c["_ahead"], ahead).otherwise(end))
    later = F.array(span(start, end), F.when(c["_back"] | c["_ahead"], grown))
    first = F.array(
        span(start, end), F.when(back.isNotNull(), span(back, end)), F.when(ahead.isNotNull(), span(start, ahead)),
        F.when(back.isNotNull() & ahead.isNotNull(), span(back, ahead)),
    )
    return F.array_compact(F.when(c["_later"], later).otherwise(first))


def repeated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id and _spans (struct s, e; disjoint, in order) of the lines to remove, one row per document that has any.

    The rows are written; what was written on the way is deleted.
    """
    with scratch_folder(docs.sparkSession, "lines") as folder:
        return staged(_repeated(docs, id_col, text_col, folder), "lines-spans")


def _repeated(docs: DataFrame, id_col: str, text_col: str, folder: str) -> DataFrame:
    found = chunks(docs, id_col, text_col)
    at = _place()
    counts = found.groupBy("_hash").agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_first"),
        F.min_by("_prev", at).alias("_first_prev"), F.min_by("_next", at).alias("_first_next"),
    )
    twice = staged(counts.where(F.col("_n") > 1).drop("_n"), "repeated", folder)
    # The first chunk of a hash takes part in the comparison, but is never removed.
    later = at != F.col("_first")
    wanted = found.join(twice, "_hash").select(
        "_id", "_start", "_end", "_before", "_after", later.alias("_later"),
        F.coalesce(F.col("_prev") == F.col("_first_prev"), F.lit(False)).alias("_back"),
        F.coalesce(F.col("_next") == F.col("_first_next"), F.lit(False)).alias("_ahead"),
    )
    of = wanted.groupBy("_id").agg(F.collect_set(F.struct(*wanted.columns[1:])).alias("_chunks"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(of, "_id")
    spans = F.array_distinct(F.flatten(F.transform("_chunks", _variants)))
    cut = _let(F.split("_text", "\n", -1), lambda lines: F.transform(spans, lambda c: F.struct(
        c["s"], c["e"], c["later"], F.array_join(F.slice(lines, c["s"] + 1, c["e"] - c["s"] + 1), "\n").alias("t"),
    )))
    own = texts.select("_id", F.explode(cut).alias("c")).select(
        "_id", F.col("c.s").alias("_start"), F.col("c.e").alias("_end"), F.col("c.t").alias("_chunk"), "c.later"
    )
    own = staged(own, "chunks", folder)
    firsts = own.groupBy("_chunk").agg(F.min(_place()).alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = staged(firsts.where(F.col("_n") > 1).drop("_n"), "first", folder)
    # A chunk that overlaps the first one of its own text stays with it.
    gone = own.where("later").join(firsts, "_chunk").where(
        _place() - F.col("_first") > F.col("_end") - F.col("_start")
    ).groupBy("_id").agg(F.collect_set(F.struct(F.col("_start").alias("s"), F.col("_end").alias("e"))).alias("_spans"))
    return gone.select("_id", _merged(F.col("_spans")).alias("_spans"))


def _without(lines: Column, spans: Column) -> Column:
    """The lines outside of disjoint spans in order."""
    def between(own: Column) -> Column:
        def part(k: Column) -> Column:
            start = F.coalesce(F.get(spans, k - 1)["e"] + 1, F.lit(0))
            end = F.coalesce(F.get(spans, k)["s"], F.size(own))
            return F.slice(own, start + 1, F.greatest(end - start, F.lit(0)))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), part))

    return _let(lines, between)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "lines_removed"
) -> DataFrame:
    """``docs`` without later repetitions of chunks of lines, and the number of lines removed.

    Ids are integers. Of equal chunks the one in the document with the smallest id
    stays, and there the first. Rows that repeat an id count as one document and keep
    what it keeps. A null id takes no part, a text with fewer than two lines that are
    not blank has no chunk: both come back as they are, as does a line that is
    repeated without a neighbour. A text of which only blank lines would be left
    becomes empty. Other columns are kept; columns named like those used here do not
    matter.
    """
    hidden, names = fields.hide(docs, keep=(id_col, text_col))
    gone = repeated(docs.select(id_col, text_col), id_col, text_col).select(F.col("_id").alias(id_col), "_spans")
    lines = F.split(text_col, "\n", -1)
    kept = F.array_join(_without(lines, F.col("_spans")), "\n")
    count = F.aggregate("_spans", F.lit(0), lambda n, c: n + c["e"] - c["s"] + 1)
    joined = hidden.join(gone, id_col, "left").withColumn(
        "_kept", F.when(F.col("_spans").isNotNull(), kept)
    )
    empty = F.col("_kept").isNotNull() & ~F.col("_kept").rlike(r"[^\s]")
    text = F.when(empty, F.lit("")).otherwise(F.coalesce(F.col("_kept"), F.col(text_col)))
    removed = F.when(empty, F.size(lines)).otherwise(F.coalesce(count, F.lit(0)))
    return joined.select(
        *(text.alias(text_col) if c == text_col else F.col(h).alias(c) for c, h in names if c != removed_col),
        removed.cast("long").alias(removed_col),
    )
