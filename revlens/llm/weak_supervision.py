"""Quality rules by weak supervision, with DataFrame functions only.

Each rule looks at a few counts of a text and votes good (1), bad (-1) or
abstains (0).  Expectation-maximisation over the vote patterns of the whole
texts that pass the base rule estimates how often each rule is right, on good and on bad texts, and
how common good texts are;
a text is kept when its posterior probability of being good is at least one
half.  No labels are used.

The patterns are one row each (at most ``3 ** number of rules``), so the
iterations run over one small array in a single expression; the corpus is read
once for the counts and written, once more for the verdict.

Defined results: a null or empty text has no word, fails the base rule and is
not kept; repeated rows are judged row by row; an empty table gives no rows;
extra columns pass through unless they have the name of a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._stage import stage

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 8
ITERATIONS = 25
# (name, column expression, good at most, bad above): votes good below the first bound, bad beyond the second.
RULES = [
    ("symbols", "n_symbols / n_words", 0.05, 0.3),
    ("repeats", "n_repeat_words / n_words", 0.05, 0.2),
    ("dup_lines", "n_dup_lines / n_words", 0.005, 0.03),
    ("capitals", "n_upper / word_chars", 0.2, 0.5),
    ("long_words", "word_chars / n_words", 10.0, 14.0),
    ("brevity", "-n_words", -50, -20),
]
# Where the iterations start, and the bounds that keep an estimate from 0 and 1:
# share of good texts, right votes on good texts, right votes on bad texts.  The
# rules condemn only clear cases, so each may be wrong on two good texts in a
# thousand at most, and none may define a bad text alone; without these bounds
# the largest kind of bad text would stand for all of them.
START = (0.9, 0.998, 0.5)
BOUNDS = ((0.5, 0.99), (0.998, 0.9999), (0.05, 0.7))


def base_counts(docs: DataFrame) -> DataFrame:
    """All columns plus ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper`` (long)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"]
    docs = docs.drop(*[c for c in names if c in docs.columns])
    t = F.coalesce("text", F.lit(""))
    d = docs.withColumn("__words", F.regexp_extract_all(t, F.lit(f"({WORD})"), F.lit(1)))
    d = d.withColumn("__lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("__words")
    d = d.withColumn("__h", F.transform(F.col("__words"), lambda w: F.xxhash64(w)))
    # size("__h") here keeps the hashes a column of their own: a column that is
    # used once would be put inside the lambda below and computed for each window
    m = F.size("__h")
    at = F.when(m >= WINDOW, F.sequence(F.lit(1), m - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("__win", F.transform(at, lambda i: F.xxhash64(F.slice("__h", i, WINDOW))))
    twice = F.size(F.array_distinct("__win")) < F.size("__win")
    # (hash, place) in order; a window counts when a neighbour has its hash
    d = d.withColumn("__sorted", F.when(twice, F.array_sort(F.transform(
        F.col("__win"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("__sorted")
    same = lambda x, j, step: F.coalesce(F.get(s, j + step)["h"] == x["h"], F.lit(False))
    d = d.withColumn("__places", F.array_sort(F.transform(F.filter(
        s, lambda x, j: same(x, j, -1) | same(x, j, 1)), lambda x: x["i"])))
    p = F.col("__places")
    # consecutive windows overlap: each adds the words up to the next place, eight at most
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return d.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.aggregate("__words", F.lit(0), lambda a, w: a + F.length(w)).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_upper"))


def votes() -> Column:
    """One vote per rule; every rule abstains on a text without words."""
    out = []
    for _, value, good, bad in RULES:
        v = F.expr(f"CASE WHEN n_words > 0 THEN {value} END")
        out.append(F.when(v <= good, 1).when(v > bad, -1).otherwise(0))
    return F.array(*out)


def _posterior(votes: Column, params: Column) -> Column:
    """Probability that a text with these votes is good."""
    g, b = params["on_good"], params["on_bad"]
    for_good = F.zip_with(g, b, lambda x, y: F.log(x / (1 - y)))
    for_bad = F.zip_with(g, b, lambda x, y: F.log((1 - x) / y))
    each = F.zip_with(F.zip_with(votes, for_good, lambda v, w: F.when(v == 1, w).otherwise(0.0)),
                      F.zip_with(votes, for_bad, lambda v, w: F.when(v == -1, w).otherwise(0.0)), lambda x, y: x + y)
    score = F.aggregate(each, F.log(params["good"] / (1 - params["good"])), lambda s, x: s + x)
    return 1 / (1 + F.exp(-score))


def _within(x: Column, bounds) -> Column:
    return F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), x))


def estimate(patterns: DataFrame) -> DataFrame:
    """One row ``params(good, on_good array, on_bad array)`` from rows ``v`` (votes) and ``n`` (texts).

    ``on_good`` and ``on_bad`` are the shares of a rule's votes that are right
    on good and on bad texts; abstentions count in neither.
    """
    k = len(RULES)
    one = patterns.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("rows"))
    start = F.struct(F.lit(START[0]).alias("good"), F.array(*[F.lit(START[1])] * k).alias("on_good"),
                     F.array(*[F.lit(START[2])] * k).alias("on_bad"))
    sums = ["good_cast", "good_right", "bad_cast", "bad_right"]

    def step(params, _):
        weighed = F.transform("rows", lambda r: F.struct(r["v"].alias("v"), r["n"].cast("double").alias("n"),
                                                         (r["n"] * _posterior(r["v"], params)).alias("g")))
        zero = F.struct(F.lit(0.0).alias("all"), F.lit(0.0).alias("good"),
                        *[F.array(*[F.lit(0.0)] * k).alias(c) for c in sums])

        def add(a, r):
            adds = {"good_cast": lambda v: F.when(v != 0, r["g"]), "good_right": lambda v: F.when(v == 1, r["g"]),
                    "bad_cast": lambda v: F.when(v != 0, r["n"] - r["g"]), "bad_right": lambda v: F.when(v == -1, r["n"] - r["g"])}
            return F.struct((a["all"] + r["n"]).alias("all"), (a["good"] + r["g"]).alias("good"),
                            *[_summed(a[c], r["v"], f).alias(c) for c, f in adds.items()])

        # one made-up text for and one against keeps every share defined
        return F.aggregate(weighed, zero, add, lambda a: F.struct(
            _within((a["good"] + 1.0) / (a["all"] + 2.0), BOUNDS[0]).alias("good"),
            F.zip_with(a["good_right"], a["good_cast"], lambda x, c: _within((x + 1.0) / (c + 2.0), BOUNDS[1])).alias("on_good"),
            F.zip_with(a["bad_right"], a["bad_cast"], lambda x, c: _within((x + 1.0) / (c + 2.0), BOUNDS[2])).alias("on_bad")))

    return one.select(F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), start, step).alias("params"))


def _summed(sums: Column, votes: Column, part) -> Column:
    return F.zip_with(sums, votes, lambda s, v: s + F.coalesce(part(v), F.lit(0.0)))


def judge(docs: DataFrame) -> DataFrame:
    """Base counts plus ``base_failed``, ``quality`` (posterior) and ``kept``."""
    names = ["base_failed", "quality", "kept"]
    docs = docs.drop(*[c for c in names if c in docs.columns])
    counted = stage(base_counts(docs).withColumn("__v", votes()), "quality-counts")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    # texts that the base rule has decided say nothing about the others
    params = estimate(counted.where(~failed).groupBy(F.col("__v").alias("v")).agg(F.count("*").alias("n")))
    # the estimate is one row; its few numbers join each row as constants
    p = params.first()["params"]
    fixed = F.struct(F.lit(float(p["good"])).alias("good"),
                     *[F.array(*[F.lit(float(x)) for x in p[c]]).alias(c) for c in ("on_good", "on_bad")])
    return (counted.withColumn("base_failed", failed).withColumn("quality", _posterior(F.col("__v"), fixed))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop("__v"))
