"""Quality rules by robust multivariate outliers, with DataFrame functions only.

Every text gets a vector of transformed statistics. For each language and source
the minimum-covariance-determinant estimate of centre and spread is approached by
concentration steps: from medians and deviations, repeatedly take the ``SHARE`` of
rows nearest to the centre and estimate both anew from them. A row whose
Mahalanobis distance exceeds a limit is rejected.

A step is two aggregates over the statistics table, merged within tasks. Groups are
never gathered; only their estimates (one row per group) are joined back, on the
group and one of ``SALTS`` numbers that every row has, so that a source with a third of
all rows is spread over as many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import fields
from tickloom.sources.tables import staged

#: Words are runs of characters other than these.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Share of a group that a concentration step keeps, and how many steps.
SHARE = 0.75
STEPS = 3
SALTS = 64
#: Groups with fewer good rows are pooled by language, then all together.
LEAST_ROWS = 100
#: Medians of chi-squared with as many degrees of freedom as there are statistics, and the quantile
#: (0.975) within which rows count for the final estimate.
CHI2_MEDIAN = 4.351
CHI2_MOST = 12.833
#: Squared distance beyond which a row is rejected: the chance under a normal law is below 1e-9.
LIMIT = 60.0

#: Statistic -> least standard deviation assumed, so that a constant statistic does not reject any change.
STATISTICS = {"_x0": 0.25, "_x1": 0.05, "_x2": 0.05, "_x3": 0.1, "_x4": 0.1}
_X = list(STATISTICS)
_PAIRS = [(i, j) for i in range(len(_X)) for j in range(i + 1)]


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+", -1), "")


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text, the first included.

    Windows are compared by 64-bit hashes. Only texts with any equal windows are sorted.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) >= 3, windows).otherwise(F.array().cast("array<bigint>"))


def with_estimates(rows: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their group's row in ``found``."""
    every = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(every, ["_key", "_salt"], how)


def statistics(docs: DataFrame, id_col: str, text_col: str, group_cols: tuple[str, ...]) -> DataFrame:
    """Counts of every whole text; a null text has none of anything."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("_id"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_g{k}") for k, c in enumerate(group_cols)),
        text.alias("_text"), word_array(text).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    hashed = read.withColumn("_windows", repeated_words(F.col("_words")))
    nth = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = hashed.withColumn(
        "_sorted",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), nth),
    )
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter(
        "_sorted",
        lambda w, k: same(F.get("_sorted", k + 1), w) | same(F.get("_sorted", k - 1), w),
    )
    covered = F.flatten(F.transform(twice, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    n_words = F.size("_words").cast("long")
    return marked.select(
        "_id", *(f"_g{k}" for k in range(len(group_cols))),
        n_words.alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
    )


def transformed() -> list[Column]:
    """The statistic vector: logarithms of size and word length, root of symbols per word, shares."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("n_words").cast("double")).alias("_x0"),
        F.log1p(F.col("word_chars") / n).alias("_x1"),
        F.sqrt(F.col("n_symbols") / n).alias("_x2"),
        (F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1))).alias("_x3"),
        (F.col("n_repeat_words") / n).alias("_x4"),
    ]


def pooled(rows: DataFrame, group_cols: int) -> DataFrame:
    """Adds ``_key``: the group if it has enough good rows, else its first column, else all."""
    good = F.sum((~F.col("base_failed")).cast("long"))
    names = [f"_g{k}" for k in range(group_cols)]
    fine = rows.groupBy(*names).agg(good.alias("_n"))
    key = F.when(F.col("_n") >= LEAST_ROWS, F.concat_ws("\x01", F.lit("g"), *names))
    if group_cols > 1:
        coarse = fine.where(F.col("_n") < LEAST_ROWS).groupBy("_g0").agg(F.sum("_n").alias("_m"))
        fine = fine.join(coarse, "_g0", "left")
        key = key.when(F.col("_m") >= LEAST_ROWS, F.concat_ws("\x01", F.lit("l"), "_g0"))
    keyed = rows.join(fine.select(*names, key.otherwise(F.lit("a")).alias("_key")), names)
    return keyed.withColumn("_salt", F.pmod(F.xxhash64("_id", *_X), F.lit(SALTS)).cast("int"))


def moments(rows: DataFrame) -> DataFrame:
    """Per key the means and the covariance matrix, with the least deviations added."""
    cells = [F.avg(x).alias(f"m{i}") for i, x in enumerate(_X)]
    cells += [F.covar_pop(_X[i], _X[j]).alias(f"c{i}{j}") for i, j in _PAIRS]
    found = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), *cells).where(F.col("_n") >= LEAST_ROWS // 2)
    for i, least in enumerate(STATISTICS.values()):
        found = found.withColumn(f"c{i}{i}", F.col(f"c{i}{i}") + least * least)
    return inverse(found)


def inverse(found: DataFrame) -> DataFrame:
    """The inverse of the lower Cholesky factor, as columns l<row><column>, of the matrices c."""
    for i, j in _PAIRS:
        left = F.col(f"c{i}{j}")
        for k in range(j):
            left = left - F.col(f"a{i}{k}") * F.col(f"a{j}{k}")
        found = found.withColumn(f"a{i}{j}", F.sqrt(left) if i == j else left / F.col(f"a{j}{j}"))
    for j in range(len(_X)):
        found = found.withColumn(f"l{j}{j}", 1 / F.col(f"a{j}{j}"))
        for i in range(j + 1, len(_X)):
            total = F.lit(0.0)
            for k in range(j, i):
                total = total - F.col(f"a{i}{k}") * F.col(f"l{k}{j}")
            found = found.withColumn(f"l{i}{j}", total / F.col(f"a{i}{i}"))
    return found.select(
        "_key", *(f"m{i}" for i in range(len(_X))), *(f"l{i}{j}" for i, j in _PAIRS)
    )


def distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` with ``_d``, the squared Mahalanobis distance; null where there is no estimate."""
    total = F.lit(0.0)
    for i in range(len(_X)):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"l{i}{j}") * (F.col(_X[j]) - F.col(f"m{j}"))
        total = total + part * part
    return with_estimates(rows, estimates, "left").select(*rows.columns, total.alias("_d"))


def start(rows: DataFrame) -> DataFrame:
    """First estimate: medians, and deviations from them, without correlation."""
    middle = staged(
        rows.groupBy("_key").agg(*(F.percentile_approx(x, 0.5).alias(f"m{i}") for i, x in enumerate(_X))), "mcd-median"
    )
    off = with_estimates(rows, middle).groupBy("_key").agg(
        *(F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5).alias(f"d{i}") for i, x in enumerate(_X))
    )
    spread = [
        (F.lit(0.0) if i != j else 1 / F.greatest(1.4826 * F.col(f"d{i}"), F.lit(STATISTICS[_X[i]]))).alias(f"l{i}{j}")
        for i, j in _PAIRS
    ]
    return middle.join(off, "_key").select("_key", *(f"m{i}" for i in range(len(_X))), *spread)


def nearest(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """The share of each key's rows that is nearest to its centre."""
    measured = distances(rows, estimates)
    edge = measured.groupBy("_key").agg(F.percentile_approx("_d", share).alias("_edge"))
    return with_estimates(measured, edge).where(F.col("_d") <= F.col("_edge")).drop("_edge", "_d")


def scale(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Per key the factor that brings the median distance to that of a normal law."""
    return distances(rows, estimates).groupBy("_key").agg(
        (F.lit(CHI2_MEDIAN) / F.greatest(F.percentile_approx("_d", 0.5), F.lit(1e-9))).alias("_scale")
    )


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")
) -> DataFrame:
    """doc_id, the counts, base_failed, distance (null without estimate) and kept, for every text.

    A null text counts as empty and fails the base rules, as all texts of fewer than 50
    words do. Null languages or sources are one group with the empty name. Groups
    with fewer than ``LEAST_ROWS`` good rows are judged with the others of their
    language, else with all that remain, and kept if those are too few as well.
    Repeated rows count as often as they occur. An empty table gives no rows; other
    columns are ignored. A distance is scaled so that the group's median is normal,
    but never up, so a group more alike than its least deviations rejects none for it.
    """
    names, _ = fields.hide(docs.select(id_col, text_col, *group_cols), keep=(id_col, text_col, *group_cols))
    found = statistics(names, id_col, text_col, group_cols)
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    rows = staged(found.select("*", failed.alias("base_failed"), *transformed()), "quality-statistics")
    keyed = staged(pooled(rows, len(group_cols)), "quality-keys")
    good = keyed.where(~F.col("base_failed")).select("_key", "_salt", *_X)
    estimates = staged(start(good), "mcd-start")
    for _ in range(STEPS):
        estimates = staged(moments(nearest(good, estimates, SHARE)), "mcd-step")
    factor = scale(good, estimates)
    central = with_estimates(distances(good, estimates), factor).where(F.col("_d") * F.col("_scale") <= CHI2_MOST)
    estimates = staged(moments(central), "mcd-final")
    factor = staged(scale(good, estimates), "mcd-scale")
    measured = with_estimates(distances(keyed, estimates), factor, "left")
    distance = F.col("_d") * F.least(F.col("_scale"), F.lit(1.0))
    kept = ~F.col("base_failed") & F.coalesce(distance <= LIMIT, F.lit(True))
    return measured.select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", distance.alias("distance"), kept.alias("kept"),
    )
