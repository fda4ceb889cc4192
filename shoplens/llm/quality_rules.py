"""Quality rules as weak supervision.

Rules vote good, bad or abstain on document statistics. Expectation-maximisation over the counts of
vote patterns estimates how often each rule votes either way, or abstains, on good and on bad text; the
posterior probability that a document is good replaces a test that all rules pass. Rules that look for
one kind of junk vote bad or abstain, as its absence says little. Built-in functions only.

Defined results: null and empty texts have no words, fail the base test and are not kept; equal
texts get equal results; rows repeated with one ``doc_id`` stay repeated; an empty table gives no
rows; columns named like the added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import SPACE_CLASS, words_of, written

# The symbols that count, and common function words of the four languages.
SYMBOLS = "[#*$%&|<>]"
FUNCTION_WORDS = (
    "the of and to in a is that for it on with as at by this be are from or an was "
    "de la le les et en des un une du est que qui dans pour par sur au avec pas "
    "der die das und von zu mit den im ein eine ist nicht auf für "
    "el los las y que del se por con para una su al como más"
).split()

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# rule -> (good if, bad if); otherwise the rule abstains.
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words >= 80", "n_words < 30"),
    "word_length": ("word_chars BETWEEN 3 * n_words AND 7 * n_words", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    "symbols": ("n_symbols <= 0.005 * n_words", "n_symbols > 0.08 * n_words"),
    "lines": ("false", "n_dup_lines > 0.3 * n_lines"),
    "repeats": ("false", "n_repeat_words > 0.3 * n_words"),
    "capitals": ("false", "n_capitals > 0.4 * word_chars"),
    "function_words": ("n_function >= 4", "n_function < 2 AND n_words >= 30"),
    "variety": ("false", "n_distinct < 0.15 * n_words"),
}
VOTES = (-1, 0, 1)


def _window_hashes(words: Column) -> Column:
    """Sorted longs of 33 hash bits and 31 position bits, one per window of three words."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    packed = lambda w, i: F.shiftleft(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), 31).bitwiseOR(i.cast("long"))
    return F.sort_array(F.transform(starts, packed))


def _beside_equal(array: Column, key) -> Column:
    """Elements of a sorted array whose neighbour on either side has the same key."""
    def equal(x: Column, i: Column) -> Column:
        return F.coalesce(key(x) == key(F.get(array, i - 1)), F.lit(False)) | F.coalesce(key(x) == key(F.get(array, i + 1)), F.lit(False))

    return F.filter(array, equal)


def signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, counts): what the rules look at, over whole texts, in one pass without a shuffle.

    Repeated windows are found by a sort of packed hashes within the document; those whose hash
    occurs twice are then compared as words, so the counts are exact.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    step = docs.select("doc_id", filled.alias("text"), words_of(F.col(text)).alias("words"))
    step = step.select(
        "doc_id", "words", F.array_distinct("words").alias("kinds"), _window_hashes(F.col("words")).alias("windows"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{SPACE_CLASS[1:]}")).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )
    twins = _beside_equal(F.col("windows"), lambda x: F.shiftright(x, 31))
    step = step.withColumn("twins", F.transform(twins, lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")))
    word = lambda p: F.get(F.col("words"), p)
    spelt = F.sort_array(F.transform("twins", lambda p: F.struct(word(p).alias("a"), word(p + 1).alias("b"), word(p + 2).alias("c"), p.alias("p"))))
    step = step.withColumn("spelt", spelt)
    same = _beside_equal(F.col("spelt"), lambda x: F.struct(x["a"], x["b"], x["c"]))
    step = step.withColumn("starts", F.sort_array(F.transform(same, lambda x: x["p"])))
    covered = F.aggregate(
        "starts", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"],
    )
    known = F.array(*[F.lit(w) for w in dict.fromkeys(FUNCTION_WORDS)])
    return step.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), "n_capitals", F.size("lines").cast("long").alias("n_lines"),
        F.size("kinds").cast("long").alias("n_distinct"), F.size(F.array_intersect("kinds", known)).cast("long").alias("n_function"),
    )


def votes(measured: DataFrame) -> DataFrame:
    """Adds ``vote_<rule>``: 1 good, -1 bad, 0 abstains."""
    return measured.withColumns({
        f"vote_{rule}": F.when(F.expr(good), 1).when(F.expr(bad), -1).otherwise(0) for rule, (good, bad) in RULES.items()
    })


Rates = list[dict[int, tuple[float, float]]]


def fit_rates(patterns: dict[tuple[int, ...], int], n_rules: int, rounds: int = 200, tolerance: float = 1e-9) -> tuple[float, Rates]:
    """EM on pattern counts: the share of good documents and, per rule and vote, how often the rule
    votes so on good and on bad text.

    Votes are independent given the class. The start takes patterns with a bad vote for bad; a rule's
    vote never counts against its own sense (see ``weights_of``).
    """
    prior, rates = 0.8, [{v: (1 / 3, 1 / 3) for v in VOTES}] * n_rules
    total = sum(patterns.values())
    if not total:
        return prior, rates
    good = {p: n * (0.05 if -1 in p else 0.95) for p, n in patterns.items()}
    for _ in range(rounds):
        found = []
        for k in range(n_rules):
            tally = {v: [1.0, 1.0] for v in VOTES}
            for p, n in patterns.items():
                tally[p[k]][0] += good[p]
                tally[p[k]][1] += n - good[p]
            sums = [sum(t[c] for t in tally.values()) for c in (0, 1)]
            found.append({v: (t[0] / sums[0], t[1] / sums[1]) for v, t in tally.items()})
        share = min(0.999, max(0.001, sum(good.values()) / total))
        change = max([abs(share - prior), *(abs(a[v][c] - b[v][c]) for a, b in zip(found, rates, strict=True) for v in VOTES for c in (0, 1))])
        prior, rates = share, found
        good = {p: n * posterior(p, prior, rates) for p, n in patterns.items()}
        if change < tolerance:
            break
    return prior, rates


def accuracy_of(rates: dict[int, tuple[float, float]]) -> tuple[float, float]:
    """How often a rule is right when it votes, on good and on bad text."""
    return rates[1][0] / (rates[1][0] + rates[-1][0]), rates[-1][1] / (rates[1][1] + rates[-1][1])


def weights_of(prior: float, rates: Rates) -> tuple[float, list[dict[int, float]]]:
    """Log-odds of the prior, and of each rule's votes: none counts against its own sense, and
    abstaining may tilt the result but not decide it."""
    sense = {-1: lambda x: min(x, 0.0), 0: lambda x: max(-1.0, min(1.0, x)), 1: lambda x: max(x, 0.0)}
    return math.log(prior / (1 - prior)), [{v: sense[v](math.log(r[v][0] / r[v][1])) for v in VOTES} for r in rates]


def posterior(pattern: tuple[int, ...], prior: float, rates: Rates) -> float:
    base, weights = weights_of(prior, rates)
    return 1 / (1 + math.exp(-max(-500.0, base + sum(w[v] for v, w in zip(pattern, weights, strict=True)))))


def weak_supervision(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Counts, ``base_failed``, ``quality`` (posterior) and ``kept`` per document.

    The small table of counts is written once; EM needs only the counts of vote patterns, at most
    3 ** rules rows whatever the input.
    """
    voted = written(votes(signals(docs)), "signals")
    names = [f"vote_{rule}" for rule in RULES]
    counted = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    base, weights = weights_of(*fit_rates({tuple(r[c] for c in names): r["n"] for r in sorted(counted)}, len(names)))
    logit = F.lit(base)
    for name, weight in zip(names, weights, strict=True):
        logit = logit + F.when(F.col(name) > 0, weight[1]).when(F.col(name) < 0, weight[-1]).otherwise(weight[0])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = voted.withColumn("quality", 1 / (1 + F.exp(-logit))).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
