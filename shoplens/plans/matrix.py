"""The feature matrix: one written table per key set, then one join per table.

Every family is keyed by an entity, or by entity and anchor day. Families of the same key set are
joined with each other first, while they are narrow, and written once (see ``HandOver``): the
samples are then joined once per key set. The last joins carry a hint, as the rows of each table are
known: what is below the session's limit in memory is broadcast, whatever the size of its files.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.exprs import known_keys
from shoplens.operators import (
    breadth, catalogue, conversion, enrich, history, profile, ranks, samples, trailing,
)
from shoplens.plans.features import PROFILE, feature_names
from shoplens.session import HandOver, broadcast_bytes
from shoplens.settings import Calendar
from shoplens.sources.tables import Tables

SAMPLE_ID = [*samples.SAMPLE_KEYS, "anchor_date"]
DEMOGRAPHICS = ["age", "sex", "province", "city", "county"]

# Join order of the key sets: long tables first, while the samples are still narrow.
KEY_SETS = [
    ["user_id", "cate", "shop_id"], ["user_id", "shop_id"], ["user_id", "cate"], ["user_id"],
    ["shop_id", "cate"], ["shop_id"], ["cate"],
    ["sex", "shop_id"], ["age", "shop_id"], ["sex", "cate"], ["age", "cate"],
    ["age", "city"], ["age", "county"], ["age", "province"], ["sex", "city"], ["sex", "county"],
    ["sex", "province"], ["city"], ["county"], ["province"], ["age"], ["sex"],
]


def written_log(tables: Tables, hand_over: HandOver) -> DataFrame:
    """Enriched daily log, written once by day, so that windows and cut-offs read only their days.

    Rebalancing gives files of even size: small days share a task, large days are split.
    """
    log = enrich.daily_log(tables).hint("rebalance", "action_date")
    return hand_over.put("log", log, partition_by=("action_date",))


# Columns of the two roll-ups. Key sets without sku, brand or module need no more of the log.
ENTITIES = ["user_id", "cate", "shop_id"]
GROUPS = [*DEMOGRAPHICS, "cate", "shop_id"]


def roll_up(log: DataFrame, columns: list[str]) -> DataFrame:
    """Log summed over all but ``columns``, type and day. Sums of sums are exact, so every count may
    read a roll-up in place of the log."""
    return log.groupBy(*columns, "type", "action_date").agg(F.sum("n").alias("n")).hint("rebalance", "action_date")


def base_samples(log: DataFrame, tables: Tables, calendar: Calendar) -> DataFrame:
    """Labelled samples with their profile, without those that some inner join would drop.

    A sample is an action on its anchor day, so tables keyed by its user, category or shop always
    hold it. What can be missing is a registration date of the shop or a demographic key.
    """
    labelled = samples.label(samples.samples(log, calendar), log, calendar)
    profiled = profile.static_profile(labelled, tables.shops, tables.users, calendar.as_of)
    return known_keys(profiled, DEMOGRAPHICS)


def _same(a: list[str], b: list[str]) -> bool:
    return set(a) == set(b)


def dated_features(
    log: DataFrame, rolled: DataFrame, sample: DataFrame, calendar: Calendar, keys: list[str], hand_over: HandOver
) -> DataFrame | None:
    """All families keyed by (keys, anchor), or None if the key set has none. Distinct counts of
    skus, brands and modules read the log itself."""
    if not any(_same(keys, k) for k in trailing.MATRIX_KEYS):
        return None
    # Keys with a user are many and rarely active: only their active anchors are computed.
    only_active = "user_id" in keys
    counts = trailing.trailing_counts(rolled, calendar, keys, only_active)
    families = [family for family, k, _ in ranks.RANKS if _same(keys, k)]
    if families:  # several consumers: written once, not computed again for each
        counts = hand_over.put("counts_by_" + "_".join(keys), counts)
    parts = [counts]
    if keys == ["user_id"]:
        parts.append(trailing.active_days(rolled, calendar, keys, only_active))
    parts += [
        breadth.trailing_distinct(log, calendar, keys, values, only_active)
        for k, values in breadth.BREADTH
        if _same(keys, k)
    ]
    parts += [ranks.rank_family(sample, counts, calendar, family) for family in families]
    on = [*keys, "anchor_date"]
    # Never broadcast: the parts spread their keys over the anchors after the shuffle whose size Spark sees.
    return reduce(lambda left, right: left.join(right.hint("merge"), on, "left"), parts)


def undated_features(
    rolled: DataFrame, rated: DataFrame, overall: DataFrame, calendar: Calendar, keys: list[str]
) -> DataFrame | None:
    """All families keyed by the keys alone, or None."""
    parts = [
        catalogue.catalogue(rated, list(k)) for k in catalogue.OWNED if _same(keys, list(k))
    ]
    parts += [
        history.history_counts(rolled, calendar, k) for k in history.HISTORY_KEYS if _same(keys, k)
    ]
    parts += [
        conversion.conversion_rates(rolled, calendar, k, overall=overall)
        for k in conversion.ONE_KEY + conversion.TWO_KEYS
        if _same(keys, k)
    ]
    # Full joins: a key may be new to one family and known to another.
    return reduce(lambda left, right: left.join(right, keys, "full"), parts) if parts else None


def key_set_features(
    log: DataFrame, rolled: DataFrame, sample: DataFrame, rated: DataFrame, overall: DataFrame, calendar: Calendar,
    keys: list[str], hand_over: HandOver,
) -> DataFrame:
    """Every feature of one key set in one table."""
    dated = dated_features(log, rolled, sample, calendar, keys, hand_over)
    undated = undated_features(rolled, rated, overall, calendar, keys)
    if dated is None or undated is None:
        return dated if undated is None else undated
    return dated.join(undated, keys, "left")


def _packed(table: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, dict[str, str]]:
    """Features of a table as one array column, and the expression that reads each of them.

    Joining arrays keeps the rows at a few dozen fields through all joins, within generated code;
    hundreds of columns appear only in the last projection. Counts are exact as doubles and become
    integers again when read.
    """
    ids = [c for c in (*keys, "anchor_date") if c in table.columns]
    features = [(c, kind) for c, kind in table.dtypes if c not in ids]
    cells = ", ".join(f"cast({c} as double)" for c, _ in features)
    places = {c: f"cast({name}[{i}] as {kind})" for i, (c, kind) in enumerate(features)}
    return table.selectExpr(*ids, f"array({cells}) as {name}"), places


def _row_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of written tables, from their footers in one job."""
    named = reduce(DataFrame.unionAll, [table.select(F.lit(name).alias("name")) for name, table in tables.items()])
    return {**dict.fromkeys(tables, 0), **{r["name"]: r["count"] for r in named.groupBy("name").count().collect()}}


def _hinted(packed: DataFrame, rows: int, cells: int) -> DataFrame:
    """``packed`` for the right side of a join, broadcast if its ``rows`` of ``cells`` numbers are below
    the session's limit in memory. Repeated counts shrink to a fraction of that in a file."""
    return packed.hint("broadcast" if rows * 8 * (cells + 8) <= broadcast_bytes(packed.sparkSession) else "merge")


def feature_matrix(
    tables: Tables, calendar: Calendar, hand_over: HandOver, log: DataFrame | None = None
) -> DataFrame:
    """Samples with label and all features, missing values as 0."""
    if log is None:
        log = written_log(tables, hand_over)
    by_day = ("action_date",)
    entities = hand_over.put("log_of_entities", roll_up(log, ENTITIES), by_day)
    groups = hand_over.put("log_of_groups", roll_up(log, GROUPS), by_day)
    first = hand_over.put_many(
        {
            "sample": partial(base_samples, entities, tables, calendar),
            "rated_products": partial(enrich.rated_products, tables),
            "overall_rates": partial(conversion.overall_rates, groups, calendar),
        }
    )
    sample, rated, overall = first["sample"], first["rated_products"], first["overall_rates"]
    tables_by_keys = hand_over.put_many(
        {
            "by_" + "_".join(keys): partial(
                key_set_features, log, entities if set(keys) <= set(ENTITIES) else groups,
                sample, rated, overall, calendar, keys, hand_over,
            )
            for keys in KEY_SETS
        }
    )
    rows = _row_counts(tables_by_keys)
    matrix = sample
    place = {name: name for name in PROFILE}
    for keys in KEY_SETS:
        name = "by_" + "_".join(keys)
        packed, places = _packed(tables_by_keys[name], keys, name)
        place.update(places)
        on = [*keys, "anchor_date"] if "anchor_date" in packed.columns else keys
        matrix = matrix.join(_hinted(packed, rows[name], len(on) + len(places)), on, "left")
    filled = [f"coalesce({place[c]}, 0) as {c}" for c in feature_names(calendar.windows)]
    return matrix.selectExpr(*SAMPLE_ID, "flag", *filled)
