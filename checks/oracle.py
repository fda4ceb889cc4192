"""DuckDB SQL per query, written directly from the definitions: range joins, filtered distinct
counts and plain window functions over the whole tables."""

from __future__ import annotations

LAST = "date '2024-01-30'"
FIRST = "date '2024-01-23'"
CONVERSION_BEFORE = FIRST
HISTORY_BEFORE = "date '2024-01-10'"
TRAIN_BEFORE = "date '2024-01-28'"
AS_OF = "date '2025-01-01'"
WINDOWS = (1, 3, 7, 21)
TYPES = (1, 2, 3, 4, 5)

SHORT = {"user_id": "user", "shop_id": "shop", "sku_id": "sku"}
PLURAL = {"cate": "cates", "shop_id": "shops", "sku_id": "skus", "brand": "brands", "module_id": "modules"}


def name_of(keys):
    return "_".join(SHORT.get(k, k) for k in keys)


SOURCES = f"""
action as (
  select user_id, cast(json_extract_string(props, '$.k') as bigint) as sku_id, ts as action_time,
         cast(event_id % 7 as bigint) as module_id,
         case event_type when 'view' then 1 when 'purchase' then 2 when 'click' then 3
                         when 'signup' then 4 else 5 end as type
  from events),
product as (
  select p_partkey as sku_id, cast(substr(p_brand, 7) as bigint) as brand,
         case when p_size <= 45 then cast(p_partkey % 10 + 10 * floor(p_partkey / 200) as bigint) end as shop_id,
         cast(ascii(p_type) * 100 + length(p_type) as bigint) as cate
  from part),
shop as (
  select s.s_suppkey as shop_id, x.fans_num, x.vip_num, x.shop_reg_tm,
         cast(ascii(p.p_type) * 100 + length(p.p_type) as bigint) as main_cate, s.s_acctbal as shop_score
  from supplier s
  left join (select l_suppkey, count(*) as fans_num, count(distinct l_orderkey) as vip_num,
                    min(l_shipdate) as shop_reg_tm from lineitem group by 1) x on x.l_suppkey = s.s_suppkey
  left join part p on p.p_partkey = s.s_suppkey),
usr as (
  select c.c_custkey as user_id, cast(c.c_custkey % 6 + 1 as int) as age,
         case when c.c_custkey % 50 <> 49 then cast(c.c_custkey % 3 as int) end as sex,
         o.user_reg_tm, cast(floor(c.c_acctbal / 2500) as int) as user_lv_cd,
         cast(n.n_nationkey % 4 + 1 as int) as city_level, n.n_regionkey as province,
         n.n_nationkey as city, ascii(c.c_mktsegment) as county
  from customer c join nation n on c.c_nationkey = n.n_nationkey
  left join (select o_custkey, min(o_orderdate) as user_reg_tm from orders group by 1) o on o.o_custkey = c.c_custkey),
comm as (
  select l_partkey as sku_id, 1 as comments, case when l_returnflag = 'N' then 1 else 0 end as good_comments,
         case when l_returnflag = 'R' then 1 else 0 end as bad_comments from lineitem),
log as (
  select a.user_id, a.sku_id, a.module_id, a.type, cast(a.action_time as date) as action_date,
         p.brand, p.cate, p.shop_id, u.age, u.sex, u.province, u.city, u.county
  from action a join product p on a.sku_id = p.sku_id join shop s on p.shop_id = s.shop_id
  join usr u on a.user_id = u.user_id),
anchor as (select cast(unnest(generate_series({FIRST}, {LAST}, interval 1 day)) as date) as anchor_date)"""

SAMPLE = f"""
sample as (select distinct user_id, cate, shop_id, action_date as anchor_date from log
           where action_date between {FIRST} and {LAST}),
labelled as (
  select s.*, cast(exists (select 1 from log b where b.type = 2 and b.user_id = s.user_id and b.cate = s.cate
       and b.shop_id = s.shop_id and b.action_date > s.anchor_date and b.action_date <= s.anchor_date + 3) as int) as flag
  from sample s)"""

PROFILED = f"""
profiled as (
  select s.user_id, s.cate, s.shop_id, s.anchor_date, s.flag, h.fans_num, h.vip_num, h.main_cate, h.shop_score,
         u.age, u.sex, u.user_lv_cd, u.city_level, u.province, u.city, u.county,
         cast(year(h.shop_reg_tm) as int) as shop_reg_year,
         cast(datediff('day', cast(h.shop_reg_tm as date), {AS_OF}) as int) as shop_reg_days,
         case when h.main_cate = s.cate then 1 else 0 end as same_with_main_cate,
         cast(year(u.user_reg_tm) as int) as user_reg_year,
         cast(datediff('day', cast(u.user_reg_tm as date), {AS_OF}) as int) as user_reg_days
  from labelled s left join shop h on h.shop_id = s.shop_id left join usr u on u.user_id = s.user_id
  where h.shop_reg_tm is not null),
base as (select * from profiled where age is not null and sex is not null and province is not null
         and city is not null and county is not null)"""

COMMENT = """
sku_rates as (
  select sku_id, cast(sum(comments) as bigint) as sku_comment_nums,
         cast(sum(good_comments) as bigint) as sku_good_comment_nums,
         cast(sum(bad_comments) as bigint) as sku_bad_comment_nums,
         (cast(sum(good_comments) as double) + 50.0::double * (select cast(sum(good_comments) as double) / cast(sum(comments) as double) from comm))
            / (cast(sum(comments) as double) + 50.0::double) as sku_good_comment_rate,
         (cast(sum(bad_comments) as double) + 50.0::double * (select cast(sum(bad_comments) as double) / cast(sum(comments) as double) from comm))
            / (cast(sum(comments) as double) + 50.0::double) as sku_bad_comment_rate
  from comm where sku_id is not null group by 1),
rated as (select p.*, r.* exclude (sku_id) from product p left join sku_rates r on r.sku_id = p.sku_id)"""


def sql(body, *ctes):
    return "with " + ",".join([SOURCES, *ctes]) + "\n" + body


def day(column="anchor_date"):
    return f"cast({column} as varchar) as {column}"


def present(keys, alias=""):
    return " and ".join(f"{alias}{k} is not null" for k in keys)


def trailing_body(keys, windows=WINDOWS, types=TYPES):
    k = ", ".join(f"l.{c}" for c in keys)
    cols = ", ".join(
        f"count(*) filter (type = {t} and anchor_date - action_date < {n}) as {name_of(keys)}_action{t}_counts_{n}day"
        for n in windows for t in types
    )
    return (
        f"select {k}, anchor_date, {cols} from anchor join log l on action_date between anchor_date - 20 and anchor_date "
        f"where {present(keys, 'l.')} group by all"
    )


def active_days_body(keys):
    k = ", ".join(f"l.{c}" for c in keys)
    cols = ", ".join(
        f"count(distinct case when type = {t} and anchor_date - action_date < {n} then action_date end) "
        f"as {name_of(keys)}_action{t}_counts_date_{n}day"
        for n in WINDOWS for t in (2, 3, 4)
    )
    return (
        f"select {k}, anchor_date, {cols} from anchor join log l on action_date between anchor_date - 20 and anchor_date "
        f"where {present(keys, 'l.')} group by all"
    )


def breadth_body(keys, values):
    k = ", ".join(f"l.{c}" for c in keys)
    cols = ", ".join(
        f"count(distinct case when anchor_date - action_date < {n}{'' if t is None else f' and type = {t}'} then l.{v} end) "
        f"as {name_of(keys)}_action{'' if t is None else t}_{PLURAL[v]}_{n}day"
        for n in WINDOWS for v in values for t in (None, 1, 2, 3, 4)
    )
    return (
        f"select {k}, anchor_date, {cols} from anchor join log l on action_date between anchor_date - 20 and anchor_date "
        f"where {present(keys, 'l.')} group by all"
    )


def conversion_body(keys, targets=(2, 3, 4)):
    prior = f"{1000 if len(keys) == 1 else 500}.0::double"
    cols = ", ".join(
        f"(cast(count(*) filter (type = {t}) as double) + {prior} * (select cast(count(*) filter (type = {t}) as double) / "
        f"cast(count(*) filter (type = 1) as double) from log where action_date < {CONVERSION_BEFORE})) / "
        f"(cast(count(*) filter (type = 1) as double) + {prior}) as {'_'.join(keys)}_{t}_coversion_rate"
        for t in targets
    )
    k = ", ".join(keys)
    return (
        f"select {k}, {cols} from log where action_date < {CONVERSION_BEFORE} and {present(keys)} "
        f"group by {k} having count(*) filter (type = 1) > 0"
    )


def history_body(keys, types=(1, 2, 3, 4), where=f"action_date < {HISTORY_BEFORE}"):
    name = name_of(keys)
    cols = ", ".join(f"count(*) filter (type = {t}) as {name}_action{t}_times" for t in types)
    k = ", ".join(keys)
    return f"select {k}, count(*) as {name}_action_times, {cols} from log where {where} and {present(keys)} group by {k}"


def catalogue_body(keys, owned):
    name, k = name_of(keys), ", ".join(keys)
    own = ", ".join(f"count(distinct {v}) as {name}_own_{PLURAL[v]}" for v in owned)
    sums = ", ".join(
        f"cast(coalesce(sum(sku_{kind}comment_nums), 0) as bigint) as {name}_{kind}comment_nums"
        for kind in ("", "good_", "bad_")
    )
    stats = [(kind, label) for kind in ("good", "bad") for label in ("mean", "max", "min")]
    fn = {"mean": "avg", "max": "max", "min": "min"}
    rates = ", ".join(f"{fn[l]}(sku_{g}_comment_rate) as {name}_{g}_comm_rate_{l}" for g, l in stats)
    filled = ", ".join(
        f"round(coalesce({name}_{g}_comm_rate_{l}, avg({name}_{g}_comm_rate_{l}) over ()), 6) as {name}_{g}_comm_rate_{l}"
        for g, l in stats
    )
    plain = [f"{name}_own_{PLURAL[v]}" for v in owned] + [f"{name}_{kind}comment_nums" for kind in ("", "good_", "bad_")]
    return (
        f"select {k}, {', '.join(plain)}, {filled} from (select {k}, {own}, {sums}, {rates} from rated "
        f"where {present(keys)} group by {k})"
    )


RANKS = [
    ("user_like_cate", ["user_id", "cate"], "user_id"), ("ruser_like_cate", ["user_id", "cate"], "cate"),
    ("user_like_shop", ["user_id", "shop_id"], "user_id"), ("ruser_like_shop", ["user_id", "shop_id"], "shop_id"),
    ("sex_like_cate", ["sex", "cate"], "sex"), ("sex_like_shop", ["sex", "shop_id"], "sex"),
    ("age_like_cate", ["age", "cate"], "age"), ("age_like_shop", ["age", "shop_id"], "age"),
]


def rank_body(family, keys, group):
    counts = trailing_body(keys, types=(1,))
    k = ", ".join(f"b.{c}" for c in keys)
    cols = ", ".join(
        f"cume_dist() over (partition by b.{group}, b.anchor_date order by coalesce(c.{name_of(keys)}_action1_counts_{n}day, 0) desc) "
        f"as {family}{n}_rank"
        for n in WINDOWS
    )
    on = " and ".join(f"c.{c} = b.{c}" for c in [*keys, "anchor_date"])
    return f"select distinct * from (select {k}, b.anchor_date, {cols} from base b left join ({counts}) c on {on})"


SCORED = """
scored as (
  select s.user_id, s.cate, s.shop_id, s.anchor_date, s.flag,
    cast(100 * count(*) filter (l.type = 1 and l.cate = s.cate and s.anchor_date - l.action_date < 7)
       + 10 * count(*) filter (l.type = 1 and l.shop_id = s.shop_id and s.anchor_date - l.action_date < 7)
       + count(*) filter (l.type = 1) as double) as score
  from labelled s join log l on l.user_id = s.user_id and l.action_date between s.anchor_date - 20 and s.anchor_date
  group by all)"""

# Splits of the first tree: gains of each cut between distinct values, with the penalties of the objective.
FIRST_SPLITS = """
counts as (
  select row_number() over () as id, s.flag,
    count(*) filter (l.type = 1 and l.cate = s.cate and s.anchor_date - l.action_date < 7) as a,
    count(*) filter (l.type = 1 and l.shop_id = s.shop_id and s.anchor_date - l.action_date < 7) as b,
    count(*) filter (l.type = 1) as c
  from labelled s join log l on l.user_id = s.user_id and l.action_date between s.anchor_date - 20 and s.anchor_date
  group by s.user_id, s.cate, s.shop_id, s.anchor_date, s.flag),
p as (select avg(flag::double) as p from counts),
cells as (
  select id, p - flag as g, p * (1 - p) as h, unnest([1, 2, 3]) as f, unnest([a, b, c]) as v from counts, p),
cuts as (select f, v, (v + lead(v) over (partition by f order by v)) / 2.0::double as threshold from (select distinct f, v from cells)),
{levels}
"""
SPLIT_LEVEL = """
{name}_sums as (
  select side, f, v, sum(g) as g, sum(h) as h, count(*) as n from cells join {name}_rows using (id) group by all),
{name}_left as (
  select side, f, v, sum(g) over w as gl, sum(h) over w as hl, sum(n) over w as nl, sum(g) over t as g, sum(h) over t as h, sum(n) over t as n
  from {name}_sums window w as (partition by side, f order by v), t as (partition by side, f)),
{name}_gains as (
  select side, f, threshold, power(greatest(abs(gl) - 10, 0), 2) / (hl + 2) + power(greatest(abs(g - gl) - 10, 0), 2) / (h - hl + 2)
    - power(greatest(abs(g) - 10, 0), 2) / (h + 2) as gain
  from {name}_left join cuts using (f, v)
  where nl >= 20 and n - nl >= 20 and hl >= 1e-3 and h - hl >= 1e-3 and threshold is not null),
{name}_best as (
  select * from (select *, row_number() over (partition by side order by round(gain, 6) desc, f, threshold) as r from {name}_gains)
  where r = 1 and gain > 0)"""
SPLITS = FIRST_SPLITS.format(levels=",".join([
    "root_rows as (select id, 'root' as side from counts)", SPLIT_LEVEL.format(name="root"),
    "next_rows as (select id, case when v <= threshold then 'left' else 'right' end as side from cells join root_best using (f))",
    SPLIT_LEVEL.format(name="next"),
]))

CLASSES = f"""
classes as (
  select user_id, count(*) as user_action_times, {', '.join(f'count(*) filter (type = {t}) as user_action{t}_times' for t in TYPES)},
         case when count(*) filter (type = 2) = count(*) then 1
              when count(*) filter (type = 5 and action_date between {LAST} and {LAST}) > 0 then 2 else 3 end as user_class
  from log group by 1)"""


def top(source, where, p):
    return (
        f"select user_id, cate, shop_id from {source} where {where} and score > "
        f"(select quantile_cont(score, {p}) from {source} where {where})"
    )


def picked(source, p_last, p_before, where="true", last=LAST):
    return (
        top(source, f"{where} and anchor_date = {last}", p_last) + " union "
        + top(source, f"{where} and anchor_date = {last} - 1", p_before)
    )


SEGMENTED = "seg as (select s.*, c.user_class from scored s join classes c on c.user_id = s.user_id)"
SEG2 = picked("seg", 0.92, 0.98, "user_class = 2")
SEG3 = picked("seg", 0.92, 0.98, "user_class = 3")
POOLED = picked("seg", 0.92, 0.99, "user_class in (2, 3)")
CONSENSUS = f"({POOLED}) intersect (({SEG2}) union ({SEG3}))"

CONV1 = ["cate", "user_id", "shop_id", "province", "city", "county", "age", "sex"]
CONV2 = [
    ("user_id", "cate"), ("user_id", "shop_id"), ("cate", "shop_id"), ("age", "shop_id"), ("age", "cate"),
    ("age", "province"), ("age", "city"), ("age", "county"), ("sex", "shop_id"), ("sex", "cate"),
    ("sex", "province"), ("sex", "city"), ("sex", "county"),
]
TRAILING = [
    ("shop_id",), ("user_id",), ("cate",), ("province",), ("city",), ("county",), ("age",), ("sex",),
    ("user_id", "cate"), ("user_id", "shop_id"), ("sex", "cate"), ("sex", "shop_id"), ("age", "cate"), ("age", "shop_id"),
]
TRAILING_EXTRA = [
    ("sku_id",), ("brand",), ("user_id", "sku_id"), ("user_id", "brand"), ("sex", "sku_id"), ("sex", "brand"),
    ("age", "sku_id"), ("age", "brand"), ("cate", "shop_id"), ("user_id", "cate", "shop_id"),
]
BREADTH = [
    (("user_id",), ("cate", "module_id", "shop_id", "sku_id")), (("shop_id",), ("sku_id", "brand")),
    (("cate",), ("shop_id", "sku_id", "brand")), (("user_id", "cate"), ("shop_id", "sku_id", "brand")),
]
HISTORY = [
    ("user_id",), ("shop_id",), ("cate",), ("user_id", "cate"), ("shop_id", "cate"), ("user_id", "shop_id"),
    ("user_id", "cate", "shop_id"),
]
CATALOGUE = [
    (("shop_id",), ("sku_id", "brand", "cate")), (("cate",), ("sku_id", "brand", "shop_id")),
    (("shop_id", "cate"), ("sku_id", "brand")),
]


def dated(body):
    """Body with its anchor day as text."""
    return f"select * replace (cast(anchor_date as varchar) as anchor_date) from ({body})"


def matrix_sql(feature_names):
    """Every family joined to the base samples."""
    families = [(("user_id",), active_days_body(("user_id",)), True)]
    families += [(k, trailing_body(k), True) for k in TRAILING]
    families += [(k, breadth_body(k, v), True) for k, v in BREADTH]
    families += [(tuple(k), rank_body(f, k, g), True) for f, k, g in RANKS]
    families += [(k, history_body(k), False) for k in HISTORY]
    families += [((k,), conversion_body((k,)), False) for k in CONV1]
    families += [(k, conversion_body(k), False) for k in CONV2]
    families += [(k, catalogue_body(k, v), False) for k, v in CATALOGUE]
    joins = []
    for i, (keys, body, with_anchor) in enumerate(families):
        on = " and ".join(f"f{i}.{c} = b.{c}" for c in [*keys, *(["anchor_date"] if with_anchor else [])])
        joins.append(f"left join ({body}) f{i} on {on}")
    profile = {"fans_num", "vip_num", "main_cate", "shop_score", "age", "sex", "user_lv_cd", "city_level", "province",
               "city", "county", "shop_reg_year", "shop_reg_days", "same_with_main_cate", "user_reg_year", "user_reg_days"}
    cols = ", ".join(f"coalesce({'b.' if c in profile else ''}{c}, 0) as {c}" for c in feature_names)
    body = (
        f"select b.user_id, b.cate, b.shop_id, cast(b.anchor_date as varchar) as anchor_date, b.flag, {cols} from base b "
        + " ".join(joins)
    )
    return sql(body, SAMPLE, PROFILED, COMMENT)


def purchases(alias="p"):
    return f"(select distinct user_id, cate, shop_id, action_date from log where type = 2) {alias}"


EVALUATION_LAST = "date '2024-01-27'"


def evaluation_sql():
    sample = f"""
sample as (select distinct user_id, cate, shop_id, action_date as anchor_date from log
           where action_date between {EVALUATION_LAST} - 7 and {EVALUATION_LAST}),
labelled as (select *, 0 as flag from sample)"""
    parts = f"""
chosen as ({picked('scored', 0.5, 0.7, 'true', EVALUATION_LAST)}),
truth as (select distinct user_id, cate, shop_id from log where type = 2
          and action_date > {EVALUATION_LAST} and action_date <= {EVALUATION_LAST} + 3),
p as (select (select count(*) from (select distinct user_id, cate from chosen)) as pp,
             (select count(*) from (select distinct user_id, cate from truth)) as pa,
             (select count(*) from (select user_id, cate from chosen intersect select user_id, cate from truth)) as ph,
             (select count(*) from chosen) as tp, (select count(*) from truth) as ta,
             (select count(*) from (select * from chosen intersect select * from truth)) as th),
r as (select *, coalesce(ph::double / nullif(pp, 0), 0) as ppr, coalesce(ph::double / nullif(pa, 0), 0) as pre,
             coalesce(th::double / nullif(tp, 0), 0) as tpr, coalesce(th::double / nullif(ta, 0), 0) as tre from p),
f as (select *, coalesce(2.0::double * ppr * pre / nullif(ppr + pre, 0), 0) as pf,
             coalesce(2.0::double * tpr * tre / nullif(tpr + tre, 0), 0) as tf from r)"""
    body = """select pp as pair_predicted, pa as pair_actual, ph as pair_hits, round(ppr, 6) as pair_precision,
 round(pre, 6) as pair_recall, round(pf, 6) as pair_f, tp as triple_predicted, ta as triple_actual, th as triple_hits,
 round(tpr, 6) as triple_precision, round(tre, 6) as triple_recall, round(tf, 6) as triple_f,
 round(0.4::double * pf + 0.6::double * tf, 6) as score from f"""
    return sql(body, sample, SCORED, parts)


def oracle(feature_names):
    """Query name -> SQL."""
    out = {}
    out["enriched_actions"] = sql(
        f"select user_id, sku_id, module_id, type, {day('action_date')}, brand, cate, shop_id, age, sex, province, city, county from log"
    )
    out["sku_comment_rates"] = sql("select * from sku_rates", COMMENT)
    out["samples"] = sql(dated("select * from sample"), SAMPLE)
    out["samples_labelled"] = sql(
        dated(f"select *, anchor_date + 3 <= {LAST} as label_complete from labelled"), SAMPLE
    )
    flags = ", ".join(
        f"cast(exists (select 1 from log b where b.type = 2 and b.user_id = s.user_id and b.cate = s.cate and b.shop_id = s.shop_id "
        f"and b.action_date > s.anchor_date and b.action_date <= s.anchor_date + {h}) as int) as flag_{h}" for h in (1, 3, 4, 7)
    )
    out["label_horizons"] = sql(dated(f"select s.*, {flags} from sample s"), SAMPLE)
    waits = ", ".join(f"cast(coalesce(b.action_date - s.anchor_date <= {h}, false) as int) as flag_{h}" for h in (1, 3, 4, 7, 90))
    out["label_next_purchase"] = sql(dated(
        f"select s.*, {waits} from sample s asof left join (select distinct user_id, cate, shop_id, action_date from log where type = 2) b "
        f"on b.user_id = s.user_id and b.cate = s.cate and b.shop_id = s.shop_id and b.action_date > s.anchor_date"
    ), SAMPLE)
    out["resumed_samples"] = sql(dated("select * from labelled"), SAMPLE)
    cell = {c: f"coalesce({c}::varchar, '')" for c in ("sku_id", "brand", "shop_id", "cate")}
    start, end = f"{cell['sku_id']} || ','", f"{cell['brand']} || ',' || {cell['shop_id']}"
    out["quarantined_lines"] = sql(
        f"select case sku_id % 4 when 0 then 'row' else 'broken' end as kind, case sku_id % 4 when 0 then sku_id::varchar "
        f"when 1 then {start} || {end} when 2 then {start} || {end} || ',' || {cell['cate']} || ',' || {cell['sku_id']} "
        f"else {start} || '\"' || {end} || ',' || {cell['cate']} end as line from product"
    )

    def labelled_grain(keys):
        k = ", ".join(keys)
        same = " and ".join(f"b.{c} = s.{c}" for c in keys)
        return sql(dated(
            f"select s.*, cast(exists (select 1 from log b where b.type = 2 and {same} and b.action_date > s.anchor_date "
            f"and b.action_date <= s.anchor_date + 3) as int) as flag from (select distinct {k}, action_date as anchor_date "
            f"from log where action_date between {FIRST} and {LAST}) s"
        ))

    out["samples_user_cate_last_day"] = sql(
        dated("select user_id, cate, max(action_date) as anchor_date from log group by 1, 2")
    )
    out["samples_user_sku"] = labelled_grain(("user_id", "sku_id"))
    out["samples_user_cate"] = labelled_grain(("user_id", "cate"))
    out["samples_cate_shop"] = labelled_grain(("cate", "shop_id"))
    out["static_profile"] = sql(dated("select * exclude (flag) from profiled"), SAMPLE, PROFILED)
    for keys, owned in CATALOGUE:
        out[f"{name_of(keys)}_catalogue"] = sql(catalogue_body(keys, owned), COMMENT)
    for key in CONV1:
        out[f"conv1_{key}"] = sql(conversion_body((key,)))
    for keys in CONV2:
        out["conv2_" + "_".join(keys)] = sql(conversion_body(keys))
    out["conv_cart"] = sql(conversion_body(("user_id", "cate"), targets=(5,)))
    for keys in TRAILING + TRAILING_EXTRA:
        out[f"trailing_{name_of(keys)}"] = sql(dated(trailing_body(keys)))
    out["trailing_user_cate_active"] = sql(dated(
        f"select t.* from ({trailing_body(('user_id', 'cate'))}) t semi join log l on l.user_id = t.user_id and l.cate = t.cate "
        f"and l.action_date = t.anchor_date"
    ))
    out["trailing_user_cate_daily_runs"] = sql(dated(trailing_body(("user_id", "cate"))))
    out["breadth_user_daily_runs"] = sql(dated(breadth_body(*BREADTH[0])))
    out["user_active_days"] = sql(dated(active_days_body(("user_id",))))
    for keys, values in BREADTH:
        for v in values:
            out[f"breadth_{name_of(keys)}_{PLURAL[v]}"] = sql(dated(breadth_body(keys, (v,))))
    out["breadth_user_active"] = sql(dated(
        f"select t.* from ({breadth_body(('user_id',), BREADTH[0][1])}) t semi join log l on l.user_id = t.user_id "
        f"and l.action_date = t.anchor_date"
    ))
    for keys in HISTORY:
        out[f"history_{name_of(keys)}"] = sql(history_body(keys))
    out["full_outer_type_counts"] = sql(history_body(("user_id", "cate"), TYPES, "true"))
    for family, keys, group in RANKS:
        out[f"rank_{family}"] = sql(dated(rank_body(family, keys, group)), SAMPLE, PROFILED)
    out["feature_matrix"] = matrix_sql(feature_names)

    out["user_classes"] = sql("select * from classes", CLASSES.replace(f"action_date between {LAST} and {LAST}", "true"))
    out["cart_span_class"] = sql("select user_id, user_class from classes", CLASSES)
    out["segment_samples"] = sql(dated(
        "select s.* from labelled s semi join (select * from classes where user_class = 2) c on c.user_id = s.user_id"
    ), SAMPLE, CLASSES)
    out["time_split"] = sql(dated(
        f"select *, case when anchor_date < {TRAIN_BEFORE} then 'train' when anchor_date = {LAST} then 'score_last' "
        f"when anchor_date = {LAST} - 1 then 'score_before' else 'hold_out' end as part from labelled"
    ), SAMPLE)
    out["segment_conversion"] = sql(
        "select c.user_class, count(distinct c.user_id) as users, count(l.user_id) as samples, "
        "cast(coalesce(sum(l.flag), 0) as bigint) as positives, sum(l.flag)::double / nullif(count(l.user_id), 0) as conversion "
        "from classes c left join labelled l on l.user_id = c.user_id group by 1", SAMPLE, CLASSES
    )
    # Class 1 (nothing but purchases) does not look at the carts, so their span is of no concern here.
    out["class1_rule"] = sql(
        f"select l.user_id, count(*) as purchases from log l join classes c on c.user_id = l.user_id and c.user_class = 1 "
        f"where l.type = 2 and l.action_date between {LAST} - 6 and {LAST} group by 1 having count(*) >= 2", CLASSES
    )
    spread = "(values (date '2024-01-20'), (date '2024-01-25'), (date '2024-01-30')) g(anchor_date)"
    out["time_split_gaps"] = sql(dated(
        f"select s.*, cast(exists (select 1 from log b where b.type = 2 and b.user_id = s.user_id and b.cate = s.cate "
        f"and b.shop_id = s.shop_id and b.action_date > s.anchor_date and b.action_date <= s.anchor_date + 3) as int) as flag, "
        f"case anchor_date when date '2024-01-20' then 'train' when date '2024-01-25' then 'score_before' else 'score_last' end as part "
        f"from (select distinct user_id, cate, shop_id, anchor_date from log join {spread} on action_date = anchor_date) s"
    ))
    seen = "from anchor join log l on action_date between anchor_date - 89 and anchor_date"
    wide = ", ".join(
        f"count(distinct case when {'true' if t is None else f'type = {t}'} and anchor_date - action_date < {n} then {v} end) "
        f"as user_action{'' if t is None else t}_{PLURAL[v]}_{n}day" for n in (7, 90) for v in ("cate", "sku_id") for t in (None, 1, 2, 3, 4)
    )
    out["breadth_user_90day"] = sql(dated(
        f"select t.* from (select l.user_id, anchor_date, {wide} {seen} group by all) t "
        f"semi join log l on l.user_id = t.user_id and l.action_date = t.anchor_date"
    ))
    days = ", ".join(
        f"count(distinct case when type = {t} and anchor_date - action_date < {n} then action_date end) "
        f"as user_action{t}_counts_date_{n}day" for n in (7, 90) for t in (2, 3, 4)
    )
    out["active_days_90day"] = sql(dated(f"select l.user_id, anchor_date, {days} {seen} group by all"))
    out["conv1_sku_id"] = sql(conversion_body(("sku_id",)))
    out["blend_scores"] = sql(dated(
        "select *, 1.0::double * a + 1.0::double * b + (1.0::double / 3.0::double) * c as score from (select * exclude (score), "
        "score / (score + 10) as a, score / (score + 100) as b, score / (score + 1000) as c from scored)"
    ), SAMPLE, SCORED)
    out["auc_fixed_score"] = sql(
        f"select round((sum(r) filter (flag = 1) - count(*) filter (flag = 1) * (count(*) filter (flag = 1) + 1) / 2.0::double) "
        f"/ (count(*) filter (flag = 1) * count(*) filter (flag = 0)), 6) as auc from (select flag, "
        f"rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0::double as r from scored "
        f"where anchor_date >= {TRAIN_BEFORE} and anchor_date < {LAST} - 1)", SAMPLE, SCORED
    )
    out["unparsed_cells"] = sql(
        "select 'product' as table_name, unnest(['sku_id', 'brand', 'shop_id', 'cate']) as column_name, "
        "unnest([0, count(*) filter (sku_id % 4 >= 2 and brand is not null), 0, 0]) as cells from product"
    )
    out["gbt_score_contract"] = sql(dated(
        f"select user_id, cate, shop_id, anchor_date, flag, true as in_range, true as is_blend from base where anchor_date = {LAST}"
    ), SAMPLE, PROFILED)
    out["gbt_first_splits"] = sql(
        "select side as node, ['user_cate_action1_counts_7day', 'user_shop_action1_counts_7day', 'user_action1_counts_21day'][f] as feature, "
        "threshold, round(gain, 3) as gain from (select * from root_best union all select * from next_best)", SAMPLE, SPLITS
    )
    out["predicted_list_contract"] = sql("select user_id, cate, shop_id, 1 as rows, '' as fault from log where false")
    out["top_percentile"] = sql(dated(
        "select * from scored where score > (select quantile_cont(score, 0.92) from scored)"
    ), SAMPLE, SCORED)
    selection = (SAMPLE, SCORED, CLASSES, SEGMENTED)
    out["segment_selection"] = sql(SEG2, *selection)
    out["segment3_selection"] = sql(SEG3, *selection)
    out["pooled_selection"] = sql(POOLED, *selection)
    out["consensus"] = sql(CONSENSUS, *selection)
    out["results_roundtrip"] = out["segment_selection"]
    out["evaluate_selection"] = evaluation_sql()

    out["daily_curve"] = sql(f"select {day('action_date')}, type, count(*) as actions from log group by all")
    out["csv_daily_curve"] = out["daily_curve"]
    out["daily_buyers"] = sql(
        f"select {day('action_date')}, count(*) as buyers, count(*) filter (user_id in (select user_id from log where "
        f"action_date = {FIRST})) as active_buyers from {purchases()} group by all"
    )
    out["purchase_lag"] = sql(
        f"select cast(a.activity_day as varchar) as activity_day, cast(p.action_date - a.activity_day as int) as lag, "
        f"count(*) as purchases from {purchases()} join (select distinct user_id, action_date as activity_day from log) a "
        f"on a.user_id = p.user_id and p.action_date > a.activity_day and p.action_date <= a.activity_day + 7 group by all"
    )
    out["recency_lag"] = sql(
        f"select cast({FIRST} - u.last_day as int) as recency, cast(p.action_date - {FIRST} as int) as lag, count(*) as purchases "
        f"from {purchases()} join (select user_id, max(action_date) as last_day from log where action_date <= {FIRST} group by 1) u "
        f"on u.user_id = p.user_id where {FIRST} - u.last_day in (0, 1, 2) and p.action_date > {FIRST} "
        f"and p.action_date <= {FIRST} + 7 group by all"
    )
    out["abnormal_days"] = sql(
        """select t.type, cast(d.action_date as varchar) as action_date, cast(t.first_day as varchar) as first_day,
 cast(t.last_day as varchar) as last_day, coalesce(c.n, 0) as actions, t.mean_actions,
 cast(coalesce(c.n, 0) = 0 as int) as missing, cast(coalesce(c.n, 0) < 0.9::double * t.mean_actions as int) as abnormal
from (select type, min(action_date) as first_day, max(action_date) as last_day,
             count(*)::double / (select max(action_date) - min(action_date) + 1 from log) as mean_actions from log group by 1) t
cross join (select cast(unnest(generate_series(min(action_date), max(action_date), interval 1 day)) as date) as action_date from log) d
left join (select type, action_date, count(*) as n from log group by 1, 2) c on c.type = t.type and c.action_date = d.action_date"""
    )
    out["dirty_rows"] = sql(
        """select status, count(*) as actions, count(distinct user_id) as users, count(distinct sku_id) as skus from (
 select a.user_id, a.sku_id, case when p.sku_id is null then 'no product' when s.shop_id is null then 'no shop'
   when u.user_id is null then 'no user' else 'matched' end as status
 from action a left join product p on p.sku_id = a.sku_id left join shop s on s.shop_id = p.shop_id
 left join usr u on u.user_id = a.user_id) group by 1"""
    )

    def gaps(keys):
        k = ", ".join(keys)
        return sql(
            f"select {k}, count(*) as active_days, cast(min(action_date) as varchar) as first_day, "
            f"cast(max(action_date) as varchar) as last_day, cast({LAST} - max(action_date) as int) as recency, "
            f"avg(gap) as gap_mean, cast(min(gap) as int) as gap_min, round(var_samp(gap), 6) as gap_var from ("
            f"select *, action_date - lag(action_date) over (partition by {k} order by action_date) as gap from "
            f"(select distinct {k}, action_date from log where action_date <= {LAST})) group by {k}"
        )

    out["gap_user"] = gaps(("user_id", "type"))
    out["gap_user_any"] = gaps(("user_id",))
    out["gap_cate"] = gaps(("cate", "type"))
    out["gap_user_cate"] = gaps(("user_id", "cate", "type"))

    def favourite(owner, item, where):
        return sql(
            f"select {owner}, {item} as top_{item}, n as actions from (select {owner}, {item}, count(*) as n, "
            f"row_number() over (partition by {owner} order by count(*) desc, {item}) as r from log where {where} "
            f"group by 1, 2) where r = 1"
        )

    out["favourite_shop"] = favourite("user_id", "shop_id", "type = 1")
    out["shop_top_cate"] = favourite("shop_id", "cate", "true")
    out["browse_share"] = sql(
        "select user_id, shop_id, n as actions, n::double / sum(n) over (partition by user_id) as share from "
        "(select user_id, shop_id, count(*) as n from log where type = 1 group by 1, 2)"
    )
    out["user_sequences"] = sql(
        "select user_id, step // 16 as piece, cast(count(*) as int) as n_steps, "
        "string_agg(sku_id || ':' || type, '>' order by step) as steps from (select user_id, sku_id, type, "
        "row_number() over (partition by user_id order by action_time, sku_id, type) - 1 as step from action) group by 1, 2"
    )
    return out
