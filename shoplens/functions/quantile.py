"""Exact percentiles of many groups at once: a sketch proposes a bracket, a counting pass proves it."""

from __future__ import annotations

from functools import reduce
from math import inf, isinf, nan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a bracket, at most, whose distinct values are fetched.
FEW = 4096
# Size of a quantile sketch, steps in which it is read, and how many of them its cuts lie beyond the wanted
# rank's own. The margin is over the sketch's error; a cut that misses costs one more pass, never the answer.
SKETCH, STEPS, MARGIN = 8192, 1024, 2
PARTS = ("below", "low", "inside", "high", "above")


def exact_percentiles(df: DataFrame, column: str, fractions: dict[object, float], group: str | None = None) -> dict[object, float | None]:
    """Percentile, with linear interpolation between order statistics, of each wanted group.

    ``fractions`` maps a value of the column ``group`` to its fraction (without ``group``, any one key).
    The first pass counts and sketches the finite values. Two quantiles of the sketch around the wanted
    rank cut the values in five parts: below, equal to the lower cut, between, equal to the upper one, above.
    The next pass counts these parts exactly and sketches the one between, which by rank holds about one row in 200
    whatever the values are. So three passes answer up to 800,000 rows per group, and each further one 200 times
    as many. A pass gives one row of ``STEPS`` numbers per group to the driver, the last at most ``FEW``
    values; no value is shuffled or ordered outside the last bracket.

    Null and NaN values do not count. Infinities count as the smallest and largest values; an answer between
    a finite and an infinite value is infinite, between the two infinities NaN.
    """
    for fraction in fractions.values():
        if not 0.0 <= fraction <= 1.0:
            raise ValueError("fractions must lie in [0, 1]")
    names = list(fractions)
    whose = F.col(group) if group else F.lit(names[0])
    index = reduce(lambda c, i: c.when(whose == F.lit(names[i]), i), range(1, len(names)), F.when(whose == F.lit(names[0]), 0))
    rows = df.select(index.alias("i"), F.col(column).cast("double").alias("v")).where("i is not null and v is not null and not isnan(v)")
    answers: dict[object, float | None] = {name: None for name in names}
    # i -> lower end, upper end, rows below the lower end, rows within, position of the answer
    open_, cuts = _first_pass(rows, {i: fractions[names[i]] for i in range(len(names))}, answers, names)
    while open_:
        last = {i for i, bracket in open_.items() if bracket[3] <= FEW}
        for i, found in _count_out(rows, {i: open_[i] for i in last}).items():
            answers[names[i]] = _interpolated(found, *open_.pop(i)[2::2])
        if open_:
            open_, cuts, found = _narrowed(rows, open_, cuts)
            answers.update({names[i]: answer for i, answer in found.items()})
    return answers


def exact_percentile(df: DataFrame, column: str, fraction: float) -> float | None:
    """Percentile of one column; None without values."""
    return exact_percentiles(df, column, {0: fraction})[0]


def _case(i_to_value: dict[int, object]) -> Column:
    pairs = [x for i, v in i_to_value.items() for x in (F.lit(i), F.lit(v))]
    return F.element_at(F.create_map(*pairs), F.col("i"))


def _inside(rows: DataFrame, brackets: dict[int, tuple]) -> DataFrame:
    ends = rows.where(F.col("i").isin(*brackets)).withColumns(
        {"low": _case({i: b[0] for i, b in brackets.items()}), "high": _case({i: b[1] for i, b in brackets.items()})}
    )
    return ends.where("v between low and high")


def _grid(n: Column) -> Column:
    """The sketch's quantiles in ``STEPS`` equal steps; null without rows, of which there are ``n``."""
    return F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit([k / STEPS for k in range(STEPS + 1)]))).alias("grid")


def _cuts(grid: list[float], position: float, n: int) -> tuple[float, float]:
    """Values of ``n`` sketched rows before and behind a position, ``MARGIN`` steps beyond its own step."""
    step = position / max(n - 1, 1) * STEPS
    return grid[max(int(step) - MARGIN, 0)], grid[min(int(step) + 1 + MARGIN, STEPS)]


def _first_pass(rows: DataFrame, fractions: dict[int, float], answers: dict, names: list) -> tuple[dict[int, tuple], dict[int, tuple]]:
    finite = F.when(F.abs("v") < inf, F.col("v"))
    counted = rows.groupBy("i").agg(
        F.count_if(F.col("v") == -inf).alias("under"), F.count_if(F.col("v") == inf).alias("over"), F.count(finite).alias("n"),
        F.min(finite).alias("low"), F.max(finite).alias("high"), F.kll_sketch_agg_double(finite, SKETCH).alias("sketch"),
    )
    open_, cuts = {}, {}
    for r in counted.select("i", "under", "over", "n", "low", "high", _grid(F.col("n"))).collect():
        i, at = r["i"], (r["under"] + r["n"] + r["over"] - 1) * fractions[r["i"]]
        parts = [(r["under"], -inf, -inf), (r["n"], r["low"], r["high"]), (r["over"], inf, inf)]
        _, answer, bracket = _located(parts, 0, at)
        if bracket:
            open_[i], cuts[i] = bracket, _cuts(r["grid"], at - r["under"], r["n"])
        else:
            answers[names[i]] = answer
    return open_, cuts


def _located(parts: list[tuple], below: int, position: float) -> tuple[int, float | None, tuple | None]:
    """Of ordered parts (rows, smallest, largest): the one with the answer's two order statistics, then the answer
    if that is decided, else the bracket it lies in."""
    ranks, found = (int(position // 1), int(-(-position // 1))), []
    for number, (n, least, greatest) in enumerate(parts):
        found += [(number, below, n, least, greatest) for rank in ranks if below <= rank < below + n]
        below += n
    (first, before, n, least, greatest), (second, _, _, other, _) = found
    if first != second:
        return first, _between(greatest, other, position), None
    if least == greatest:
        return first, least, None
    return first, None, (least, greatest, before, n, position)


def _narrowed(rows: DataFrame, brackets: dict[int, tuple], cuts: dict[int, tuple]) -> tuple[dict[int, tuple], dict[int, tuple], dict[int, float]]:
    """Narrower brackets with their next cuts, and the answers of groups that are decided. Cuts are values
    of the rows, and no next bracket holds them, so every pass narrows."""
    v, low, high = F.col("v"), F.col("cut_low"), F.col("cut_high")
    part = F.when(v < low, 0).when(v == low, 1).when(v < high, 2).when(v == high, 3).otherwise(4)
    held = _inside(rows, brackets).withColumns({
        "cut_low": _case({i: cuts[i][0] for i in brackets}), "cut_high": _case({i: cuts[i][1] for i in brackets}),
    }).select("i", "v", part.alias("part"))
    sums = []
    for number, name in enumerate(PARTS):
        own = F.when(F.col("part") == number, v)
        sums += [F.count(own).alias(f"n_{name}"), F.min(own).alias(f"min_{name}"), F.max(own).alias(f"max_{name}")]
    sketch = F.kll_sketch_agg_double(F.when(F.col("part") == 2, v), SKETCH).alias("sketch")
    columns = [f"{what}_{name}" for name in PARTS for what in ("n", "min", "max")]
    counted = held.groupBy("i").agg(*sums, sketch).select("i", *columns, _grid(F.col("n_inside")))
    narrower, next_cuts, answers = {}, {}, {}
    for r in counted.collect():
        i = r["i"]
        parts = [(r[f"n_{name}"], r[f"min_{name}"], r[f"max_{name}"]) for name in PARTS]
        number, answer, bracket = _located(parts, brackets[i][2], brackets[i][4])
        if bracket is None:
            answers[i] = answer
        else:
            narrower[i] = bracket
            # Outside the cuts nothing is sketched yet; the bracket's own ends are cuts that serve.
            next_cuts[i] = _cuts(r["grid"], bracket[4] - bracket[2], bracket[3]) if number == 2 else bracket[:2]
    return narrower, next_cuts, answers


def _count_out(rows: DataFrame, brackets: dict[int, tuple]) -> dict[int, list[tuple[float, int]]]:
    if not brackets:
        return {}
    found: dict[int, list[tuple[float, int]]] = {i: [] for i in brackets}
    for r in _inside(rows, brackets).groupBy("i", "v").agg(F.count("*").alias("n")).collect():
        found[r["i"]].append((r["v"], r["n"]))
    return {i: sorted(values) for i, values in found.items()}


def _interpolated(values: list[tuple[float, int]], below: int, position: float) -> float:
    lower = upper = None
    upto = below
    for value, n in values:
        upto += n
        if lower is None and upto > position // 1:
            lower = value
        if upto > -(-position // 1):
            upper = value
            break
    return _between(lower, upper, position)


def _between(lower: float, upper: float, position: float) -> float:
    """The value at ``position`` between two neighbours, the lower one at its floor."""
    share = position - position // 1
    if lower == upper or not share:
        return lower
    if isinf(lower) or isinf(upper):
        return nan if isinf(lower) and isinf(upper) else lower if isinf(lower) else upper
    # The difference of two finite values may overflow.
    return lower + (upper - lower) * share if not isinf(upper - lower) else lower * (1 - share) + upper * share
