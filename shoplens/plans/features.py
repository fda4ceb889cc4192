"""Names and order of the feature columns, generated from the operators' fixed lists."""

from __future__ import annotations

from shoplens.functions.exprs import VALUE_NAMES, short_name
from shoplens.operators import breadth, catalogue, conversion, history, ranks, trailing
from shoplens.settings import ACTION_TYPES, WINDOWS

# Profile columns in result order.
PROFILE = [
    "fans_num", "vip_num", "main_cate", "shop_score", "age", "sex", "user_lv_cd", "city_level",
    "province", "city", "county", "shop_reg_year", "shop_reg_days", "same_with_main_cate",
    "user_reg_year", "user_reg_days",
]


def catalogue_features() -> list[str]:
    names = []
    for keys, owned in catalogue.OWNED.items():
        name = short_name(keys)
        names += [f"{name}_own_{VALUE_NAMES[v]}" for v in owned]
        names += [f"{name}_{kind}comment_nums" for kind in ("", "good_", "bad_")]
        names += [
            f"{name}_{kind}_comm_rate_{stat}" for kind in ("good", "bad") for stat in ("mean", "max", "min")
        ]
    return names


def conversion_features() -> list[str]:
    return [
        conversion.rate_name(keys, t)
        for keys in conversion.ONE_KEY + conversion.TWO_KEYS
        for t in conversion.TARGET_TYPES
    ]


def trailing_features(windows: tuple[int, ...] = WINDOWS) -> list[str]:
    names = []
    for n in windows:
        for keys in trailing.MATRIX_KEYS:
            names += [trailing.count_name(keys, t, n) for t in ACTION_TYPES]
            if keys == ["user_id"]:
                names += [trailing.day_count_name(keys, t, n) for t in trailing.ACTIVE_DAY_TYPES]
    return names


def breadth_features(windows: tuple[int, ...] = WINDOWS) -> list[str]:
    names = []
    for n in windows:
        for keys, values in breadth.BREADTH:
            # Fixed value: users list "any type" first, the other key sets list it last.
            single = list(breadth.BREADTH_TYPES)
            kinds = [None, *single] if keys == ["user_id"] else [*single, None]
            names += [breadth.breadth_name(keys, t, v, n) for v in values for t in kinds]
    return names


def history_features() -> list[str]:
    return [
        f"{short_name(keys)}_action{kind}_times"
        for keys in history.HISTORY_KEYS
        for kind in ("", *history.HISTORY_TYPES)
    ]


def rank_features(windows: tuple[int, ...] = WINDOWS) -> list[str]:
    return [ranks.rank_name(family, n) for family, _, _ in ranks.RANKS for n in windows]


def feature_names(windows: tuple[int, ...] = WINDOWS) -> list[str]:
    """All feature columns in result order: 713 for the four default windows."""
    return (
        PROFILE + catalogue_features() + conversion_features() + trailing_features(windows)
        + breadth_features(windows) + history_features() + rank_features(windows)
    )
