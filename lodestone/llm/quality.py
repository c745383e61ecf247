"""Quality rules: base rules, then robust multivariate outliers by minimum covariance determinant (MCD).

Native DataFrame expressions only. Each text gives four transformed statistics; for each language and source the MCD
location and scatter come from concentration steps over a compact table of statistics: from a
median/MAD start and a classical start, distances are taken, the 75 % of rows nearest form the subset (cut on a histogram of
logarithmic distance bins, so groups of any size are only summed), and mean and covariance follow from the subset, until no group's log
determinant moves by more than `TOLERANCE` (at most `STEPS` steps, which is far beyond what is needed). The start with the smaller
determinant wins, the scatter is made consistent by the median distance, reweighted once, and rows
beyond the chi-squared cutoff go. Variance floors keep the determinant positive where a statistic is nearly constant; they
are the resolution of each statistic, so each alone can reach the cutoff, and the consistency factor is 1 at least, so rows within that
resolution are never outliers.

Every language and source is estimated on its own rows, whatever their number. As a few rows tell little, each estimate is the weighted mean of
the group's own and its language's pooled one (the mean of the groups' estimates by their rows), with the weights n and `PRIOR`: the same
rule at every size, which large groups hardly feel.

Defined cases: null, empty and wordless texts fail the base rules with counts of 0; a null language or source is a
group value of its own; repeated rows are judged alike; an empty table gives no rows; `filtered` keeps all columns, extra ones too.
"""

from __future__ import annotations

from math import log, log1p

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import NON_SPACE, SPACE, cut, discard, sized_join, table

MIN_WORDS, REPEAT_PERCENT, SUBSET, STEPS, TOLERANCE, PRIOR = 50, 50, 0.75, 20, 0.01, 32
CUTOFF = 33.38  # chi-squared, 4 degrees, upper tail 1e-6
MEDIAN, REWEIGHT = 3.357, 11.143  # chi-squared, 4 degrees: median and 97.5 %
# Least standard deviations: half a unit as a reader would state each statistic, half a character on a mean word of six and half a percentage point.
FLOORS = (log(6.5 / 6), log1p(0.5), log1p(0.5), log1p(0.5))
MORE_LINES, MORE_WORDS = 20, 200  # shares of repeats are taken as if the text had so many more: one repeated line in a short text is no evidence
P, STARTS = 4, ("m", "c")
GROUPS = 200_000  # languages and sources whose estimates are broadcast


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable cannot be inlined again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, k: int = 3) -> Column:
    """Words in k-word windows that occur twice or more, the first occurrence too. Windows are compared by 64-bit hashes."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (k - 1), F.lit(0)))
    hashes = F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(p, i + 1) - x, F.lit(k))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def positions(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda e: F.sort_array(F.transform(F.filter(e, lambda x, i: F.coalesce(x["h"] == F.get(e, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(e, i + 1)["h"], F.lit(False))), lambda x: x["i"])))

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(positions(h), covered)))


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long) to the kept columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NON_SPACE))
    by_word = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"), repeated_words(w).cast("long").alias("repeat")))
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long")
    found = docs.select(*keep, by_word.alias("_w"), by_line.alias("_l"), symbols.alias("n_symbols"))
    return found.select(*keep, F.col("_w.n").alias("n_words"), F.col("_w.chars").alias("word_chars"), "n_symbols", F.col("_l.n").alias("n_lines"), F.col("_l.dup").alias("n_dup_lines"), F.col("_w.repeat").alias("n_repeat_words"))


def statistics() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log(F.greatest(F.col("word_chars") / n, F.lit(0.1))), F.log1p(100 * F.col("n_symbols") / n), F.log1p(100.0 * F.col("n_dup_lines") / (F.col("n_lines") + MORE_LINES)), F.log1p(100 * F.col("n_repeat_words") / (n + MORE_WORDS))]


X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def moments(s: str, where: str = "true") -> list[Column]:
    """Mean and covariance sums of start s over the rows where `where`, a boolean column, holds. As SQL text, like the next two: one call a column instead of one an operator."""
    pick = lambda x: x if where == "true" else f"CASE WHEN {where} THEN {x} END"
    return [F.expr(f"avg({pick(x)}) AS {s}_m{i}") for i, x in enumerate(X)] + [F.expr(f"covar_pop({pick(f'x{i}')}, x{j}) AS {s}_s{i}{j}") for i, j in PAIRS]


def factor(groups: DataFrame, *starts: str) -> DataFrame:
    """Adds for each start the Cholesky factor s_l?? of covariance plus floors and the log determinant s_det. One row per group; a column of all factors is one projection."""

    def left(s: str, i: int, j: int) -> str:
        return " - ".join([f"coalesce({s}_s{i}{j}, 0D) + {FLOORS[i] ** 2 if i == j else 0.0!r}D", *[f"{s}_l{i}{k} * {s}_l{j}{k}" for k in range(j)]])

    for j in range(P):
        groups = groups.select("*", *[F.expr(f"sqrt(greatest({left(s, j, j)}, 1e-12D)) AS {s}_l{j}{j}") for s in starts])
        if j < P - 1:
            groups = groups.select("*", *[F.expr(f"({left(s, i, j)}) / {s}_l{j}{j} AS {s}_l{i}{j}") for s in starts for i in range(j + 1, P)])
    return groups.select("*", *[F.expr(" + ".join(["0D", *[f"2 * ln({s}_l{i}{i})" for i in range(P)]]) + f" AS {s}_det") for s in starts])


def distance(s: str) -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[str] = []
    for i in range(P):
        v = " - ".join([f"x{i} - coalesce({s}_m{i}, 0D)", *[f"{s}_l{i}{j} * {y[j]}" for j in range(i)]])
        y.append(f"(({v}) / {s}_l{i}{i})")
    return F.expr(" + ".join(["0D", *[f"{v} * {v}" for v in y]]))


def bin_of(d: Column) -> Column:
    return F.floor(16 * F.log2(d + 1e-6)).cast("int")


def quantile_bins(rows: DataFrame, parts: dict[str, tuple[Column, float]]) -> DataFrame:
    """Per group and name the least bin that covers the share of its rows: one summed histogram, no sort of rows."""
    each = rows.select("grp", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), bin_of(d).alias("b")) for k, (d, _) in parts.items()])).alias("e")).groupBy("grp", "e.k", "e.b").count()
    up = W.partitionBy("grp", "k").orderBy("b").rowsBetween(W.unboundedPreceding, 0)
    share = F.element_at(F.create_map(*[F.lit(x) for k, (_, q) in parts.items() for x in (k, q)]), F.col("k"))
    reached = each.withColumn("_up", F.sum("count").over(up)).withColumn("_all", F.sum("count").over(W.partitionBy("grp", "k"))).filter(F.col("_up") >= share * F.col("_all"))
    return reached.groupBy("grp").agg(*[F.min(F.when(F.col("k") == k, F.col("b"))).alias(f"{k}_bin") for k in parts])


def shrunk(groups: DataFrame, columns: list[str], prior: float) -> DataFrame:
    """Each column of a group towards the pooled one of its language: (n own + prior pooled) / (n + prior). One row per group."""
    lang = W.partitionBy("_lang")
    pooled = groups.withColumns({f"_p_{c}": F.sum(F.col("_n") * F.coalesce(F.col(c), F.lit(0.0))).over(lang) / F.sum("_n").over(lang) for c in columns})
    own = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return pooled.withColumns({c: (F.col("_n") * own(c) + prior * F.col(f"_p_{c}")) / (F.col("_n") + prior) for c in columns}).drop(*[f"_p_{c}" for c in columns])


def estimates(rows: DataFrame, steps: int = STEPS, prior: float = PRIOR) -> DataFrame:
    """Per group the reweighted MCD: r_m?, r_l?? and r_scale (the consistency factor). rows: grp, _lang and the statistics."""
    med = rows.groupBy("grp").agg(F.first("_lang").alias("_lang"), F.count(F.lit(1)).alias("_n"), *[F.percentile_approx(x, 0.5).alias(f"m_m{i}") for i, x in enumerate(X)], *moments("c"))
    med = cut(med)
    groups = med.select("grp", "_lang", "_n")
    few = groups.limit(GROUPS + 1).count() <= GROUPS  # every small table below has a row per group: one count proves all
    with_groups = lambda big, small: big.join(F.broadcast(small) if few else small, "grp")
    mad = with_groups(rows, med.drop("_lang")).groupBy("grp").agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_m{i}")), 0.5).alias(f"_mad{i}") for i, x in enumerate(X)])
    start = med.drop("_lang", "_n").join(mad, "grp").withColumns({f"m_s{i}{j}": (1.4826 * F.col(f"_mad{i}")) ** 2 if i == j else F.lit(0.0) for i, j in PAIRS})
    now = cut(factor(start, *STARTS))
    for _ in range(steps):
        near = with_groups(rows, now).select("grp", *X, *[distance(s).alias(f"{s}_d") for s in STARTS], *[F.col(f"{s}_det").alias(f"{s}_was") for s in STARTS])
        bins = cut(quantile_bins(near, {s: (F.col(f"{s}_d"), SUBSET) for s in STARTS}))
        inside = with_groups(near, bins).withColumns({f"{s}_in": bin_of(F.col(f"{s}_d")) <= F.col(f"{s}_bin") for s in STARTS})
        new = inside.groupBy("grp").agg(*[m for s in STARTS for m in moments(s, f"{s}_in")], *[F.first(f"{s}_was").alias(f"{s}_was") for s in STARTS])
        new = cut(factor(new, *STARTS))
        done = new.filter(" OR ".join(f"abs({s}_det - {s}_was) > {TOLERANCE}D" for s in STARTS)).isEmpty()
        discard(bins)
        discard(now)
        now = new
        if done:
            break
    means = [f"m{i}" for i in range(P)] + [f"s{i}{j}" for i, j in PAIRS]
    best = now.join(groups, "grp").select("grp", "_lang", "_n", *[F.when(F.col("m_det") <= F.col("c_det"), F.col(f"m_{c}")).otherwise(F.col(f"c_{c}")).alias(f"b_{c}") for c in means])

    def scaled(est: DataFrame, s: str) -> DataFrame:
        est = cut(factor(shrunk(est, [f"{s}_{c}" for c in means], prior), s))
        half = quantile_bins(with_groups(rows, est.drop("_lang", "_n")).select("grp", distance(s).alias("d")), {"h": (F.col("d"), 0.5)})
        own = F.greatest(F.pow(F.lit(2.0), (F.col("h_bin") + 0.5) / 16) / MEDIAN, F.lit(1.0))
        return cut(shrunk(est.join(half, "grp").withColumn(f"{s}_scale", own).drop("h_bin"), [f"{s}_scale"], prior))

    raw = scaled(best, "b")
    kept = with_groups(rows, raw.drop("_lang", "_n")).withColumn("r_in", distance("b") <= REWEIGHT * F.col("b_scale")).groupBy("grp").agg(*moments("r", "r_in"))
    return scaled(kept.join(groups, "grp"), "r")


def judged(docs: DataFrame, *keep: str, min_words: int = MIN_WORDS, cutoff: float = CUTOFF, prior: float = PRIOR) -> DataFrame:
    """The kept columns, the counts, base_failed, kept, distance (null where base rules failed)."""
    full = docs
    for c in ("lang", "source"):
        if c not in docs.columns:
            full = full.withColumn(c, F.lit(None).cast("string"))
    named = full.select(*[F.col(c) for c in dict.fromkeys([*keep, "text"])], F.struct(F.col("lang").cast("string").alias("l"), F.col("source").cast("string").alias("s")).alias("_g"))
    counts = measured(named, *keep, "_g")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    key = F.to_json(F.struct("_g"))
    rows = cut(counts.withColumn("base_failed", failed).withColumns(dict(zip(X, statistics()))).withColumn("grp", key).withColumn("_lang", F.col("_g.l")))
    found = estimates(rows.filter("NOT base_failed").select("grp", "_lang", *X), prior=prior).drop("_lang", "_n")
    out = sized_join(rows, found, ["grp"], "left").withColumn("distance", F.when(~F.col("base_failed"), distance("r") / F.col("r_scale")))
    return out.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"), "distance")


def filtered(docs: DataFrame, **kw) -> DataFrame:
    """The documents kept, all columns."""
    keyed = docs.select("doc_id", "text", *[c for c in ("lang", "source") if c in docs.columns], F.xxhash64("text").alias("_h"))
    verdicts = judged(keyed, "doc_id", "_h", **kw).filter("kept").select("doc_id", "_h").distinct()
    return docs.alias("d").join(verdicts.alias("v"), F.col("d.doc_id").eqNullSafe(F.col("v.doc_id")) & (F.xxhash64("d.text") == F.col("v._h")), "left_semi")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), "doc_id")
