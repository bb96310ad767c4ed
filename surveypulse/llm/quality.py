"""Quality rules (2), in SQL functions only: robust multivariate outliers.

Base rules fail a document with few words or with mostly repeated words. For the rest, five
transformed statistics (length, word length, symbols per word, repeated lines, repeated words) make
a vector; per language and source the minimum covariance determinant estimates where vectors lie:
the mean and covariance of that 75 % of them whose own ellipsoid is smallest. It starts from medians
and median deviations and takes concentration steps, each of which keeps the nearest 75 % under the
estimate before. A document is rejected if its squared Mahalanobis distance under the last estimate
exceeds the 99.99 % point of chi-square with five degrees of freedom.

Quantiles come from counts of fine bins, so they are merged before the shuffle, follow the input
exactly whatever its partitioning, and no group is sorted in one task. A fixed variance is added for
each statistic (``SLACK``), since most are zero in most documents; it also says how far a statistic
may lie off in a group where it never varies.

Edge cases: null or blank text has zero words and fails. Null language or source count as ''. Groups
of fewer than ``LEAST`` documents that pass the base rules are judged by their language's estimate, those
of languages as small by that of all documents, so every document has a verdict. Very long lines and texts are treated whole. Repeated rows count each time. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse.llm.common import SPACES, written

WORDS_LEAST, REPEATED_MOST = 50, 50
SLACK = (0.5, 0.04, 0.1, 0.15, 0.2)
#: 99.99 % and the factor that makes the covariance of the inner 75 % consistent, for five normal variables.
CUT, FACTOR, SHARE, STEPS, LEAST = 25.74, 1.41, 0.75, 4, 20
#: Estimates of so many groups (some 200 bytes each) at most are sent to all tasks; more are joined by shuffle.
GROUPS_SENT = 20_000
P = range(1, 6)
GROUP = "lang, source"

#: The vector from the counts; n is at least 50 where it is used.
VECTOR = {
    1: "ln(1 + n_words)",
    2: "ln(1 + 1.0 * word_chars / greatest(n_words, 1))",
    3: "sqrt(1.0 * n_symbols / greatest(n_words, 1))",
    4: "sqrt(1.0 * n_dup_lines / greatest(n_lines, 1))",
    5: "sqrt(1.0 * n_repeat_words / greatest(n_words, 1))",
}
FAILED = f"(n_words < {WORDS_LEAST} OR 100 * n_repeat_words > {REPEATED_MOST} * n_words)"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more, the first included."""
    size = F.size(words)
    windows = F.transform(F.slice(words, 1, size - 2), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)))

    def count(wins: Column) -> Column:
        def marked(sorted_: Column) -> Column:
            twice = F.transform(
                sorted_,
                lambda e, k: F.when(
                    (e["w"] == F.get(sorted_, k - 1)["w"]) | (e["w"] == F.get(sorted_, k + 1)["w"]), e["i"]
                ),
            )
            places = F.array_sort(F.filter(twice, lambda x: x.isNotNull()))
            start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
            step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"))
            return F.aggregate(places, start, step, lambda acc: acc["n"])

        by_window = F.array_sort(F.transform(wins, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(wins)) < F.size(wins), let(by_window, marked)).otherwise(F.lit(0).cast("long"))

    return F.when(size < 3, F.lit(0).cast("long")).otherwise(let(windows, count))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``_q`` of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACES + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    doubled = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    chars = F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long")
    symbols = (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")
    return docs.withColumn("_q", F.struct(
        counts.alias("w"), doubled.alias("l"), chars.alias("word_chars"), symbols.alias("n_symbols"),
    )).withColumn("_q", F.struct(
        F.col("_q.w.n_words"), F.col("_q.word_chars"), F.col("_q.n_symbols"), F.col("_q.l.n_lines"),
        F.col("_q.l.n_dup_lines"), F.col("_q.w.n_repeat_words"),
    ))


# SQL that Spark and the checking engine both run; {f} holds lang, source, x1..x5, {s} the estimates.

def vectors(source: str) -> str:
    """Each vector in three groups: its language and source, its language, and all. A name has ``=`` before
    it, so that a wider group, named '' there, is no group of documents without a name."""
    xs = ", ".join(f"{VECTOR[i]} AS x{i}" for i in P)
    names = ("'=' || lang AS lang, '=' || source AS source", "'=' || lang AS lang, '' AS source", "'' AS lang, '' AS source")
    return " UNION ALL ".join(f"SELECT {n}, {xs} FROM {source} WHERE NOT {FAILED}" for n in names)


def chosen() -> str:
    """The estimate for each language and source: its own, or its language's, or that of all documents,
    whichever is the first with enough rows; the last counts whatever its size. {s} holds all estimates."""
    enough = f"size >= {SHARE} * {LEAST}"
    pick = lambda c: f"CASE WHEN a.{enough} THEN a.{c} WHEN b.{enough} THEN b.{c} ELSE w.{c} END AS {c}"
    columns = [f"m{i}" for i in P] + [f"l{i}{j}" for i in P for j in range(1, i + 1)]
    return (f"SELECT substr(a.lang, 2) AS lang, substr(a.source, 2) AS source, {', '.join(map(pick, columns))} "
            "FROM (SELECT * FROM {s} WHERE source <> '') a JOIN (SELECT * FROM {s} WHERE lang <> '' AND source = '') b ON b.lang = a.lang "
            "JOIN (SELECT * FROM {s} WHERE lang = '') w ON w.lang = b.source")


def quantile(bins: str, share: float) -> str:
    """The first bin b of each group and c with ``share`` of its rows at or below it."""
    return (f"SELECT {GROUP}, c, min(b) AS b FROM (SELECT {GROUP}, c, b, sum(n) OVER (PARTITION BY {GROUP}, c ORDER BY b) AS a, "
            f"sum(n) OVER (PARTITION BY {GROUP}, c) AS t FROM (SELECT {GROUP}, c, b, count(*) AS n FROM ({bins}) u GROUP BY {GROUP}, c, b) v) w "
            f"WHERE a >= {share} * t GROUP BY {GROUP}, c")


def wide(narrow: str, name: str) -> str:
    return f"SELECT {GROUP}, " + ", ".join(f"max(CASE WHEN c = {i} THEN b / 256.0 END) AS {name}{i}" for i in P) + f" FROM ({narrow}) q GROUP BY {GROUP}"


def medians() -> str:
    bins = " UNION ALL ".join(f"SELECT {GROUP}, {i} AS c, CAST(floor(x{i} * 256) AS BIGINT) AS b FROM {{f}}" for i in P)
    return wide(quantile(bins, 0.5), "m")


def deviations() -> str:
    """Medians with the median deviation from each; {s} holds medians."""
    bins = " UNION ALL ".join(
        f"SELECT f.lang, f.source, {i} AS c, CAST(floor(abs(x{i} - m{i}) * 256) AS BIGINT) AS b FROM {{f}} f JOIN {{s}} s ON f.lang = s.lang AND f.source = s.source"
        for i in P)
    return wide(quantile(bins, 0.5), "d")


def start() -> str:
    """The first estimate, without covariances; {s} holds medians, {d} deviations."""
    means = ", ".join(f"m{i}" for i in P)
    roots = ", ".join(
        f"sqrt(1.4826 * 1.4826 * d{i} * d{i} + {SLACK[i - 1] ** 2:.6f}) AS l{i}{j}" if i == j else f"CAST(0 AS DOUBLE) AS l{i}{j}"
        for i in P for j in range(1, i + 1))
    return f"SELECT s.lang, s.source, CAST({LEAST} AS BIGINT) AS size, {means}, {roots} FROM {{s}} s JOIN {{d}} d ON s.lang = d.lang AND s.source = d.source"


def distances(rows: str = "{f}") -> str:
    """Each row with its squared distance d2 from its group's estimate."""
    sql = f"SELECT f.*, {', '.join(f's.m{i}' for i in P)}, {', '.join(f's.l{i}{j}' for i in P for j in range(1, i + 1))} FROM {rows} f {{how}}JOIN {{s}} s ON f.lang = s.lang AND f.source = s.source"
    for i in P:
        less = "".join(f" - l{i}{j} * y{j}" for j in range(1, i))
        sql = f"SELECT *, (x{i} - m{i}{less}) / l{i}{i} AS y{i} FROM ({sql}) a"
    return f"SELECT *, {' + '.join(f'y{i} * y{i}' for i in P)} AS d2 FROM ({sql}) b"


def nearest() -> str:
    """The bin of distances up to which the nearest 75 % lie."""
    bins = f"SELECT {GROUP}, 1 AS c, CAST(floor(ln(d2 + 0.000001) * 64) AS BIGINT) AS b FROM ({distances().format(f='{f}', s='{s}', how='')}) g"
    return quantile(bins, SHARE)


def estimate() -> str:
    """Mean and Cholesky factor of the covariance of the nearest rows; {c} holds their bins."""
    d = distances().format(f="{f}", s="{s}", how="")
    near = f"SELECT d.* FROM ({d}) d JOIN {{c}} c ON d.lang = c.lang AND d.source = c.source WHERE floor(ln(d.d2 + 0.000001) * 64) <= c.b"
    sums = ", ".join([f"avg(x{i}) AS e{i}" for i in P] + [f"avg(x{i} * x{j}) AS p{i}{j}" for i in P for j in range(1, i + 1)])
    sql = f"SELECT {GROUP}, count(*) AS size, {sums} FROM ({near}) n GROUP BY {GROUP}"
    covs = ", ".join(f"{FACTOR} * (p{i}{j} - e{i} * e{j})" + (f" + {SLACK[i - 1] ** 2:.6f}" if i == j else "") + f" AS v{i}{j}" for i in P for j in range(1, i + 1))
    sql = f"SELECT {GROUP}, size, {', '.join(f'e{i} AS m{i}' for i in P)}, {covs} FROM ({sql}) o"
    for j in P:
        less = lambda i: "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))  # noqa: E731, B023
        sql = f"SELECT *, sqrt(v{j}{j}{less(j)}) AS l{j}{j} FROM ({sql}) h"
        if j < 5:
            sql = f"SELECT *, {', '.join(f'(v{i}{j}{less(i)}) / l{j}{j} AS l{i}{j}' for i in range(j + 1, 6))} FROM ({sql}) h"
    return f"SELECT {GROUP}, size, {', '.join(f'm{i}' for i in P)}, {', '.join(f'l{i}{j}' for i in P for j in range(1, i + 1))} FROM ({sql}) r"


VERDICT = f"NOT {FAILED} AND d2 <= {CUT}"


def sized(groups: DataFrame) -> DataFrame:
    """A written table of groups, marked for broadcast if its counted rows allow."""
    return F.broadcast(groups) if groups.count() <= GROUPS_SENT else groups


def estimated(spark, rows: DataFrame) -> DataFrame:
    """The estimate for each language and source of ``rows`` (lang, source, and the counts)."""
    rows.createOrReplaceTempView(view := f"quality_rows_{id(rows)}")
    f = spark.sql(vectors(view))
    spark.catalog.dropTempView(view)
    m = sized(written(spark.sql(medians(), f=f)))
    d = sized(written(spark.sql(deviations(), f=f, s=m)))
    s = sized(written(spark.sql(start(), s=m, d=d)))
    for _ in range(STEPS):
        c = sized(written(spark.sql(nearest(), f=f, s=s)))
        s = sized(written(spark.sql(estimate(), f=f, s=s, c=c)))
    return sized(written(spark.sql(chosen(), s=s)))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed and kept in a struct ``_q``."""
    spark = docs.sparkSession
    group = F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))))
    rows = measured(docs, text_col).select(*keep, group.alias("_g"), "_q")
    rows = written(rows)
    flat = rows.select("_g.*", "_q.*")
    s = estimated(spark, flat)
    mine = rows.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), "_g.*", "_q.*", *(F.expr(VECTOR[i]).alias(f"x{i}") for i in P))
    mine = mine.where("n_words >= 0")
    out = spark.sql(distances().format(f="{f}", s="{s}", how="LEFT "), f=mine, s=s)
    verdict = F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.expr(FAILED).alias("base_failed"),
        F.expr(f"coalesce({VERDICT}, NOT {FAILED})").alias("kept"),
    )
    return out.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), verdict.alias("_q"))


def oracle() -> str:
    """The whole operator for the checking engine, its counts taken its own way."""
    steps = {
        "w": r"SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, "
             r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents",
        "g": "SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win FROM w, unnest(range(1, len(ws) - 1)) AS r(i)",
        "h": "SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g",
        "r": "SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM h, unnest([0, 1, 2]) AS u(j) WHERE n > 1 GROUP BY doc_id",
        "b": r"SELECT w.doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, CAST(len(ws) AS BIGINT) AS n_words, "
             r"CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, "
             r"CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines, "
             r"CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words "
             r"FROM w LEFT JOIN r ON w.doc_id = r.doc_id",
        "f": vectors("b"),
        "m": medians().format(f="f"),
        "d": deviations().format(f="f", s="m"),
        "s0": start().format(s="m", d="d"),
    }
    for k in range(STEPS):
        steps[f"c{k}"] = nearest().format(f="f", s=f"s{k}")
        steps[f"s{k + 1}"] = estimate().format(f="f", s=f"s{k}", c=f"c{k}")
    xs = ", ".join(f"{VECTOR[i]} AS x{i}" for i in P)
    steps["e"] = chosen().format(s=f"s{STEPS}")
    steps["o"] = distances().format(f=f"(SELECT *, {xs} FROM b)", s="e", how="LEFT ")
    ctes = ", ".join(f"{k} AS MATERIALIZED ({v})" for k, v in steps.items())
    return (f"WITH {ctes} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {FAILED} AS base_failed, "
            f"coalesce({VERDICT}, NOT {FAILED}) AS kept FROM o")
