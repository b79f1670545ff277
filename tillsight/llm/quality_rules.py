"""Quality rules: fixed limits on repetition and length, then robust multivariate outliers.

Five statistics are counted over the words of the whole text, where a word is a run without ASCII white space.  From
them comes a vector of transformed statistics, and for each group of language and source the minimum covariance
determinant (MCD) estimates its centre and covariance: starting from medians and fixed spreads, ``STEPS`` concentration
steps refit both to the ``SUBSET`` share of rows nearest to the last fit.  The covariance of the nearest rows is widened by
``CONSISTENCY`` to that of all rows, so where a group varies far more than the floors, ``CUT`` rejects 2.5 % of normal
rows; a document whose squared Mahalanobis distance exceeds it goes.

Quantiles within a group are exact on a fine grid: rows become (group, grid value) counts before any shuffle, so a group
with a third of all rows costs no task more than another.  A group below ``LEAST`` rows takes the estimates of its
language, or of all rows if that is small too.  The square of a floor is added to each variance, as many statistics are
nearly constant: the less a group varies, the fewer rows of it are rejected.

Defined results: a null text has no words and fails the base rules, as does an empty one; null languages and sources are
groups of their own; repeated rows are judged each; an empty table gives an empty result; only id, text, language and
source are read, so other columns may clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.llm.tables import let
from tillsight.session import stage, tune

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
REPEAT = 5  # words in a window
SUBSET = 0.75
STEPS = 6
LEAST = 60
CONSISTENCY = 1.4864  # fixed value: 0.75 / P(chi-square with 6 degrees < the 0.75 quantile with 4), for normal rows
CUT = 11.143  # fixed value: 0.975 quantile of chi-square with four degrees of freedom, the customary limit
BROADCAST = 10_000  # tables with one row for each group are broadcast up to so many groups, which are counted
GRID = 200  # grid steps per unit

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Smallest spread that a transformed statistic is given.
FLOORS = {"length": 0.12, "symbols": 0.30, "lines": 0.40, "repeats": 0.20}
VECTOR = tuple(FLOORS)


def _repeated_words(words: Column) -> Column:
    """Words covered by windows of ``REPEAT`` words that occur twice or more in the text."""
    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(p, i)["h"] == F.get(p, j)["h"], F.lit(False))
            hit = F.filter(F.transform(p, lambda x, k: F.when(same(k, k - 1) | same(k, k + 1), x["i"])),
                           lambda i: i.isNotNull())
            return F.array_sort(hit)

        def union(s: Column) -> Column:
            step = lambda i, k: F.least(F.lit(REPEAT), F.coalesce(F.get(s, k + 1) - i, F.lit(REPEAT)))
            return F.aggregate(F.transform(s, step), F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(let(pairs, starts), union)).otherwise(
            F.lit(0).cast("long"))

    def windows(h: Column) -> Column:
        at = F.when(F.size(h) >= REPEAT, F.sequence(F.lit(0), F.size(h) - REPEAT)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(REPEAT)]))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), covered)


def statistics(text: Column) -> Column:
    """Struct of the five counts (long) of a whole text."""
    text = F.coalesce(text, F.lit(""))
    dup = lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))

    def of(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"),
                        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        (F.size(F.split(text, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
                        let(lines, dup).alias("n_dup_lines"), _repeated_words(words).alias("n_repeat_words"))

    return let(F.filter(F.split(text, SPACES), lambda w: w != ""), of)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vector() -> list[Column]:
    """Transformed statistics: logs and roots, with short texts drawn to the middle."""
    n = F.col("n_words").cast("double")
    return [(F.log((F.col("word_chars") + 60.0) / (n + 12.0))).alias("length"),
            (F.log1p(4.0 * F.col("n_symbols") / (n + 12.0))).alias("symbols"),
            (F.log1p(40.0 * F.col("n_dup_lines") / (n + 40.0))).alias("lines"),
            F.sqrt(F.col("n_repeat_words") / (n + 12.0)).alias("repeats")]


def _grid_quantile(rows: DataFrame, value: str, share: float) -> DataFrame:
    """(g, value): the grid value up to which at least ``share`` of the rows of each group lie."""
    counts = rows.groupBy("g", value).agg(F.count("*").alias("c"))
    upto = Window.partitionBy("g").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("upto", F.sum("c").over(upto)).withColumn("all", F.sum("c").over(Window.partitionBy("g")))
    return counts.filter(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy("g").agg(F.min(value).alias(value))


def _distance(vector: list[Column], fit: Column) -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor in ``fit``."""
    total, solved = F.lit(0.0), []
    for i in range(len(VECTOR)):
        y = vector[i] - fit[f"m{i}"]
        for j in range(i):
            y = y - fit[f"l{i}{j}"] * solved[j]
        solved.append(y / fit[f"l{i}{i}"])
        total = total + solved[i] * solved[i]
    return total


def _factored(moments: DataFrame) -> DataFrame:
    """Centre and Cholesky factor of the covariance (with floors) from sums; one row for each group."""
    k = range(len(VECTOR))
    means = moments.select("g", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in k],
                           *[(F.col(f"s{i}{j}") / F.col("n")).alias(f"q{i}{j}") for i in k for j in range(i + 1)])
    out = means
    for i in k:
        for j in range(i + 1):
            c = (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY
            if i == j:
                c = F.greatest(c, F.lit(0.0)) + FLOORS[VECTOR[i]] ** 2
            for x in range(j):
                c = c - F.col(f"l{i}{x}") * F.col(f"l{j}{x}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(1e-9))) if i == j else c / F.col(f"l{j}{j}"))
    return out.select("g", *[f"m{i}" for i in k], *[f"l{i}{j}" for i in k for j in range(i + 1)])


def _moments(rows: DataFrame) -> DataFrame:
    k = range(len(VECTOR))
    v = [F.col(c) for c in VECTOR]
    # Sums of decimals don't depend on the order of the rows.
    exact = lambda c: F.sum(c.cast("decimal(28,12)")).cast("double")
    return rows.groupBy("g").agg(F.count("*").cast("double").alias("n"), *[exact(v[i]).alias(f"s{i}") for i in k],
                                 *[exact(v[i] * v[j]).alias(f"s{i}{j}") for i in k for j in range(i + 1)])


def mcd(rows: DataFrame, groups: int) -> DataFrame:
    """(g, centre, Cholesky factor) by concentration steps over rows (g, vector), staged by the caller."""
    k = range(len(VECTOR))
    small = F.broadcast if groups <= BROADCAST else (lambda table: table)
    medians = None
    for c in VECTOR:
        grid = rows.select("g", F.floor(F.col(c) * GRID).alias(c))
        one = _grid_quantile(grid, c, 0.5)
        medians = one if medians is None else medians.join(one, "g")
    floors = list(FLOORS.values())
    fit = stage(medians.select("g", *[((F.col(c) + 0.5) / GRID).alias(f"m{i}") for i, c in enumerate(VECTOR)],
                               *[F.lit(floors[i] if i == j else 0.0).alias(f"l{i}{j}") for i in k for j in range(i + 1)]),
                "fit")
    for _ in range(STEPS):
        near = rows.join(small(fit), "g")
        near = near.select("g", *VECTOR, _distance([F.col(c) for c in VECTOR], near).alias("d"))
        near = near.withColumn("at", F.floor(F.log(F.col("d") + 1e-6) * GRID))
        limit = _grid_quantile(near.select("g", "at"), "at", SUBSET).withColumnRenamed("at", "limit")
        inside = near.join(small(limit), "g").filter("at <= `limit`")
        fit = stage(_factored(_moments(inside)), "fit")
    return fit


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """(id_col, the five counts, base_failed, distance, kept) for every row."""
    tune(docs.sparkSession)
    lang, source = (F.coalesce(F.concat(F.lit("="), docs[c].cast("string")), F.lit("-")) for c in (lang_col, source_col))
    counted = docs.select(docs[id_col].alias("id"), lang.alias("lang"), source.alias("source"),
                          statistics(docs[text_col]).alias("s")).select("id", "lang", "source", "s.*")
    counted = counted.withColumn("base_failed", base_failed())
    rows = stage(counted.select("*", *vector()), "statistics")

    passed = rows.filter(~F.col("base_failed"))
    sizes = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("lang")
    groups = sizes.select("lang", "source", F.when(F.col("n") >= LEAST, F.struct("lang", "source"))
                          .when(F.sum("n").over(by_lang) >= LEAST, F.struct("lang", F.lit("*").alias("source")))
                          .otherwise(F.struct(F.lit("*").alias("lang"), F.lit("*").alias("source"))).alias("takes"))
    groups = stage(groups, "groups")
    count = groups.count()
    small = F.broadcast if count <= BROADCAST else (lambda table: table)
    # A row counts for its own group, its language and all: each level is fitted once.
    levels = F.explode(F.array(F.struct("lang", "source"), F.struct("lang", F.lit("*").alias("source")),
                               F.struct(F.lit("*").alias("lang"), F.lit("*").alias("source"))))
    needed = groups.select(F.col("takes").alias("g")).distinct()
    counts = passed.select(levels.alias("g"), *VECTOR).join(small(needed), "g", "left_semi")
    fit = mcd(stage(counts, "levels"), count)
    fitted = groups.join(fit, groups["takes"] == fit["g"]).drop("takes", "g")
    joined = rows.join(small(fitted), ["lang", "source"], "left")
    distance = _distance([F.col(c) for c in VECTOR], joined)
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(distance <= CUT, F.lit(True)))
    return joined.select(F.col("id").alias(id_col), *STATS, "base_failed", distance.alias("distance"), kept.alias("kept"))
