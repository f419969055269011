"""SQL twins of the catalog queries, for DuckDB on the same tables."""

from __future__ import annotations

from flowsift.plans import tables as T
from flowsift.plans.catalog import ANY, PER_CLASS, SAMPLE, SPLIT_DAY, SPLIT_YEAR, TRAINING
from flowsift.spec import CATEGORIES as KNOWN
from flowsift.spec import SEED

SPACE_CLASS = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
EV = T.EV_FEATURES
EV_LIST = ", ".join(EV)
EVENT_FLOWS = """
ev as (
  select user_id, strftime(ts, '%Y-%m-%d') as flow_day,
    cast(max(epoch_us(ts)) - min(epoch_us(ts)) as double) as flow_duration,
    cast(count(*) filter (where event_type in ('click','purchase','signup')) as double) as tot_fwd,
    cast(count(*) filter (where event_type in ('view','error')) as double) as tot_bwd,
    cast(coalesce(sum(cast(value as decimal(18,2)))
      filter (where event_type in ('click','purchase','signup')), 0) as double) as len_fwd,
    cast(coalesce(sum(cast(value as decimal(18,2)))
      filter (where event_type in ('view','error')), 0) as double) as len_bwd,
    cast(sum(cast(value as decimal(18,2))) as double) as total,
    cast(count(*) as double) as n,
    cast(count(*) filter (where event_type = 'purchase') as double) as fin,
    cast(count(*) filter (where event_type = 'signup') as double) as syn,
    cast(count(*) filter (where event_type = 'error') as double) as rst,
    cast(count(*) filter (where event_type = 'click') as double) as ack
  from events group by 1, 2),
flows as (
  select user_id, flow_day, c.copy_no, flow_duration, tot_fwd, tot_bwd, len_fwd, len_bwd,
    case when tot_fwd > 0 then len_fwd / tot_fwd else 0 end as fwd_mean,
    case when tot_bwd > 0 then len_bwd / tot_bwd else 0 end as bwd_mean,
    case when flow_duration = 0 and rst > 0 then 'NaN'::double
         when flow_duration = 0 then 'Infinity'::double
         else total * 1e6::double / flow_duration end as bytes_s,
    case when flow_duration = 0 then 'Infinity'::double
         else n * 1e6::double / flow_duration end as pkts_s,
    total / n as len_mean, fin, syn, rst, ack,
    case when user_id % 50 = 7 then null when total > 400 then 'DDoS' when rst >= 2 then 'Bot'
         when user_id % 11 = 3 then ' Benign ' else 'BENIGN' end as raw_label
  from ev, (values (0), (1)) c(copy_no)
  where c.copy_no = 0 or user_id % 10 = 0)"""
LABEL = (
    "case when raw_label is null or regexp_full_match(raw_label, '" + SPACE_CLASS + "*') "
    "or contains(lower(raw_label), 'benign') then 'BENIGN' else 'ATTACK' end"
)
ENDS = f"^{SPACE_CLASS}+|{SPACE_CLASS}+$"
KINDS = " ".join(f"when '{raw}' then '{kind}'" for raw, kind in KNOWN.items())
CATEGORY = f"""case when raw_label is null then 'BENIGN' else
  case lower(regexp_replace(raw_label, '{ENDS}', '', 'g')) {KINDS} else 'Other' end end"""
RAW_LABELS = "[" + ", ".join(f"'{x}'" for x in T.RAW_LABELS) + "]"
LABELLED_FLOWS = f"""{EVENT_FLOWS},
named_flows as (
  select * replace (case when user_id % 50 <> 7
    then {RAW_LABELS}[(user_id % {len(T.RAW_LABELS)} + 1)::int] end as raw_label) from flows)"""
USABLE = " and ".join(f"isfinite({f})" for f in EV)
DEDUPED = f"""{EVENT_FLOWS},
labelled as (
  select user_id, flow_day, copy_no, raw_label as original_label, {LABEL} as label,
    {", ".join(f"case when not isnan({f}) then {f} end as {f}" for f in EV)}
  from flows),
deduped as (
  select *, count(*) over same as copies from labelled
  window same as (partition by {EV_LIST}, label)
  qualify row_number() over (partition by {EV_LIST}, label
                             order by user_id, flow_day, copy_no) = 1)"""
CLEANED = f"""{DEDUPED},
cleaned as (select * from deduped where {USABLE})"""
SCORED = f"""{EVENT_FLOWS},
scored as (
  select *, case when {LABEL} = 'ATTACK' then 1 else 0 end as y,
    (0.8::double * rst + 0.004::double * (len_fwd + len_bwd)) - 2.0::double as score
  from flows),
called as (select *, case when score > 0 then 1 else 0 end as p from scored)"""
CATEGORIES = f"""{EVENT_FLOWS},
cats as (
  select {CATEGORY} as truth,
    case when len_fwd + len_bwd > 420 then 'DDoS' when rst >= 2 or syn >= 3 then 'Bot'
         else 'BENIGN' end as called
  from flows),
cells as (select truth, called as predicted, count(*) as n from cats group by 1, 2)"""
PER_CATEGORY = f"""{CATEGORIES},
classes as (select truth as class from cells union select predicted from cells),
per as (
  select class,
    coalesce((select sum(n) from cells where truth = class and predicted = class), 0) as hits,
    coalesce((select sum(n) from cells where predicted = class), 0) as named,
    coalesce((select sum(n) from cells where truth = class), 0) as support
  from classes),
rated as (
  select class, hits, support,
    case when named > 0 then hits::double / named else 0 end as precision,
    case when support > 0 then hits::double / support else 0 end as recall
  from per),
full_report as (
  select *, case when precision + recall > 0
    then 2.0::double * precision * recall / (precision + recall) else 0 end as f1 from rated)"""
LI = """
li as (
  select concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
           cast(floor(l_extendedprice * 100.0::double + 0.5::double) as bigint)) as row_key,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    cast(year(l_shipdate) as int) as ship_year
  from lineitem)"""
LI_COLS = "row_key, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, ship_year"
LI_HASH = "md5(concat_ws('|', '42', row_key))"
EVENT_TEXT = """
texts as (
  select event_id, case event_type
    when 'view' then chr(9) || k || ' ' when 'click' then k || '.5d'
    when 'purchase' then '-' || k || 'e1' when 'error' then props
    else case when k::int < 30 then 'Infinity' when k::int < 60 then 'NaN'
              when k::int < 80 then '-inf' else '' end end as raw
  from (select *, regexp_extract(props, '[0-9]+') as k from events)),
numbers as (
  select event_id, case when regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
      or regexp_full_match(lower(t), '[+-]?(inf|infinity)') then try_cast(t as double) end as number
  from (select event_id, regexp_replace(raw, '%s', '', 'g') as t from texts))""" % ENDS
RECORDS = """
records as (
  select event_id, event_type, regexp_extract(props, '[0-9]+') as k,
    case event_type when 'view' then 'view' when 'signup' then null
      else cast(cast(value as decimal(18,2)) as varchar) end as amount
  from events),
checked as (
  select event_id, case when event_type = 'error' then 'amount' else '' end as missing,
    case when event_type in ('view', 'signup') then 'amount' else '' end as invalid
  from records)"""


def rates(tp="tp", tn="tn", fp="fp", fn="fn") -> str:
    """Accuracy, precision, recall and F1 as columns."""
    p = f"(case when {tp} + {fp} > 0 then {tp}::double / ({tp} + {fp}) else 0 end)"
    r = f"(case when {tp} + {fn} > 0 then {tp}::double / ({tp} + {fn}) else 0 end)"
    f = f"(case when {p} + {r} > 0 then 2.0::double * {p} * {r} / ({p} + {r}) else 0 end)"
    all_rows = f"({tp} + {tn} + {fp} + {fn})"
    a = f"(case when {all_rows} > 0 then ({tp} + {tn})::double / {all_rows} else 0 end)"
    return f"{a} as accuracy, {p} as precision, {r} as recall, {f} as f1"


def counts(y="y", p="p") -> str:
    return (
        f"count(*) filter (where {y} = 1 and {p} = 1) as tp, "
        f"count(*) filter (where {y} = 0 and {p} = 0) as tn, "
        f"count(*) filter (where {y} = 0 and {p} = 1) as fp, "
        f"count(*) filter (where {y} = 1 and {p} = 0) as fn"
    )


def stratified_sample(source: str, rows: str, label: str, hash_: str, size: int, cols: str) -> str:
    return f"""with {source},
sizes as (select {label} as c, count(*) as n from {rows} group by 1),
shares as (
  select c, n, sum(n) over () as total,
    n * ({size}::double / (sum(n) over ())::double) as share from sizes),
quotas as (select *, cast(greatest(1, floor(share)) as bigint) as quota from shares),
turns as (
  select *, {size} - sum(quota) over () as missing,
    row_number() over (order by share - quota desc, c) as turn from quotas),
limits as (
  select c, case when total <= {size} then n
    else least(n, quota + case when turn <= missing then 1 else 0 end) end as upto from turns),
ranked as (select *, row_number() over (partition by {label} order by {hash_}) as r from {rows})
select {cols} from ranked join limits on {label} = c where r <= upto"""


def top_n(n: int, by: str) -> str:
    return f"""with {LI}
select {LI_COLS} from li
qualify row_number() over ({by} order by {LI_HASH}) <= {n}"""


def statistics(source: str, rows: str, names: list[str], digits: int) -> str:
    one = []
    for f in names:
        one.append(f"""
select '{f}' as feature, round(m, {digits}) as mean, round(s, {digits}) as std,
  round(lo, {digits}) as min, round(q[1], {digits}) as q25, round(q[2], {digits}) as median,
  round(q[3], {digits}) as q75, round(hi, {digits}) as max,
  round(case when lo = hi then 0 else
    (m3 / n) / pow(m2 / n, 1.5) * sqrt(n * (n - 1.0)) / (n - 2.0) end, {digits}) as skewness,
  round(case when lo = hi then 0 else (n - 1.0) / ((n - 2.0) * (n - 3.0))
    * ((n + 1.0) * ((m4 / n) / pow(m2 / n, 2) - 3.0) + 6.0) end, {digits}) as kurtosis,
  missing
from (
  select count({f})::double as n, any_value(m) as m, stddev_samp({f}) as s, min({f}) as lo,
    max({f}) as hi, quantile_cont({f}, [0.25, 0.5, 0.75]) as q, count(*) - count({f}) as missing,
    sum(pow({f} - m, 2)) as m2, sum(pow({f} - m, 3)) as m3, sum(pow({f} - m, 4)) as m4
  from {rows}, (select avg({f}) as m from {rows}) a)""")
    return f"with {source}" + "\nunion all".join(one)


def comparison(
    source: str, rows: str, names: list[str], first: str, second: str, digits: int = 4
) -> str:
    one = [
        f"""
select '{f}' as feature, round(a, {digits}) as train_mean, round(b, {digits}) as shifted_mean,
  round(abs(b - a) / (sa + 1e-10::double) * 100.0::double, 2) as mean_change_pct,
  round(sa, {digits}) as train_std, round(sb, {digits}) as shifted_std,
  round(abs(sb - sa) / (sa + 1e-10::double) * 100.0::double, 2) as std_change_pct
from (select avg({f}) filter (where {first}) as a, avg({f}) filter (where {second}) as b,
        stddev_samp({f}) filter (where {first}) as sa,
        stddev_samp({f}) filter (where {second}) as sb from {rows})"""
        for f in names
    ]
    return f"with {source}" + "\nunion all".join(one)


def standardize(std: str = "stddev_pop") -> str:
    names = T.LI_FEATURES
    return f"""with {LI},
s as (select {", ".join(f"avg({f}) as m_{f}, {std}({f}) as s_{f}" for f in names)} from li)
select row_key, {", ".join(f"round(({f} - m_{f}) / s_{f}, 6) as {f}" for f in names)} from li, s"""


def perturbed() -> str:
    names = ", ".join(f"('{f}')" for f in T.LI_FEATURES)
    out = []
    for f in T.LI_FEATURES:
        h = f"md5(concat_ws('|', '42|{f}', row_key))"
        u1 = f"((('0x' || substr({h}, 1, 13))::bigint::double + 1.0::double) / 4503599627370496.0::double)"
        u2 = f"(('0x' || substr({h}, 14, 13))::bigint::double / 4503599627370496.0::double)"
        z = f"sqrt(-2.0::double * ln({u1})) * cos(2.0::double * pi() * {u2})"
        out.append(f"""round({f} + case when '{f}' in (select f from picked)
  then {z} * (select stddev_samp({f}) * 0.5::double from li) else 0 end, 5) as {f}""")
    return f"""with {LI},
picked as (select f from (values {names}) v(f) order by md5('{SEED}|' || f)
           limit {max(1, len(T.LI_FEATURES) // 3)})
select row_key, {', '.join(out)} from li"""


def covariance() -> str:
    names = T.LI_FEATURES
    of = {f: f"({f} / 1000)" if f == "l_extendedprice" else f for f in names}
    return f"with {LI}" + "\nunion all".join(
        f"\nselect '{a}' as feature_a, '{b}' as feature_b, "
        f"round(covar_samp({of[a]}, {of[b]}), 6) as covariance from li"
        for a in names for b in names)


def cell_variance() -> str:
    of = [f"{f} / 1000" if f == "l_extendedprice" else f for f in T.LI_FEATURES]
    return f"""with {LI},
cells as ({" union all ".join(f"select {f} as v from li" for f in of)})
select round(var_pop(v), 6) as variance, round(1.0 / (4.0 * var_pop(v)), 6) as gamma_scale
from cells"""


def permutation() -> str:
    names = [*T.SCORE_FEATURES, "ack"]
    score = "(0.8::double * {rst} + 0.004::double * ({len_fwd} + {len_bwd})) - 2.0::double > 0"

    def f1_of(cond: str) -> str:
        tp = f"count(*) filter (where y = 1 and {cond})"
        p = f"(case when count(*) filter (where {cond}) > 0 then {tp}::double / count(*) filter (where {cond}) else 0 end)"
        r = f"(case when count(*) filter (where y = 1) > 0 then {tp}::double / count(*) filter (where y = 1) else 0 end)"
        return f"(case when {p} + {r} > 0 then 2.0::double * {p} * {r} / ({p} + {r}) else 0 end)"

    plain = {f: f for f in T.SCORE_FEATURES}
    drops = ", ".join(
        f"{f1_of(score.format(**plain))} - {f1_of(score.format(**{**plain, f: f'd_{f}'}))} as x_{f}"
        for f in names)
    donors = ", ".join(f"coalesce(lead({f}) over w, first_value({f}) over w) as d_{f}" for f in names)
    rows = "\nunion all ".join(
        f"select '{f}' as feature, round(avg(x_{f}), 9) as importance_mean, "
        f"round(stddev_pop(x_{f}), 9) as importance_std from per" for f in names)
    return f"""with {SCORED},
hashed as (
  select y, {", ".join(names)}, r.repeat_no,
    md5(concat_ws('|', '', '42', r.repeat_no, user_id, flow_day, copy_no)) as h
  from called, range(1, 11) r(repeat_no)),
paired as (
  select y, {", ".join(names)}, repeat_no, {donors} from hashed
  window w as (partition by repeat_no order by h)),
per as (select repeat_no, {drops} from paired group by 1)
{rows}"""


def row_text(columns: dict[str, str], doubles: list[str]) -> str:
    """Values with their lengths; doubles as whole part and nine places."""
    parts = []
    for name, expr in columns.items():
        text = f"({expr})::varchar"
        if name in doubles:
            places = f"floor(({expr} - floor({expr})) * 1e9::double + 0.5::double)::bigint"
            text = f"(floor({expr})::bigint || '.' || {places})"
        parts.append(f"coalesce(length({text}) || ':' || {text}, '-')")
    return f"concat_ws('|', {', '.join(parts)})"


def split_sizes(rows: str, label: str) -> str:
    """Rows of each class on either side of a stratified split: sides(c, is_test, k)."""
    return f"""split_n as (select {label} as c, count(*)::hugeint as n from {rows} group by 1),
split_t as (
  select c, n, sum(n) over ()::hugeint as total,
    (sum(n) over () - ceil((sum(n) over ())::double * 0.2::double))::hugeint as n_train from split_n),
split_q as (select *, (n * n_train) // total as quota, (n * n_train) % total as rest from split_t),
split_turn as (
  select *, n_train - sum(quota) over () as missing,
    row_number() over (order by rest desc, c) as turn from split_q),
sides as (
  select c, n, s.is_test, cast(case when s.is_test then n - quota - (turn <= missing)::int
    else quota + (turn <= missing)::int end as bigint) as k
  from split_turn, (values (true), (false)) s(is_test))"""


def training_sample() -> str:
    key = row_text({**{f: f for f in EV}, "label": "label"}, EV)
    hash_ = "md5(concat_ws('|', '42', _key))"
    sampled = stratified_sample(
        f"{CLEANED}, keyed as (select label, md5({key}) as _key from cleaned)", "keyed", "label",
        hash_, TRAINING, "_key, label")
    return f"""with sampled as ({sampled}),
{split_sizes("sampled", "label")},
ranked as (select *, row_number() over (partition by label order by {hash_}) as r from sampled)
select _key, label, cast(label = 'ATTACK' as int) as y, r <= k as is_test
from ranked join sides on c = label and is_test"""


def pairwise_given() -> str:
    names = T.GIVEN_FEATURES
    scaled = {f: f"(({f} - m_{f}) / s_{f})" for f in names}
    wins = []
    for (a, b), (weights, intercept) in T.GIVEN_PAIRS.items():
        total = " + ".join(f"{scaled[f]} * {w}::double" for f, w in zip(names, weights))
        wins.append(f"case when {intercept}::double + {total} > 0 then {a} else {b} end as w{a}{b}")
    pairs = ["w%d%d" % p for p in T.GIVEN_PAIRS]
    votes = ", ".join(f"{' + '.join(f'({w} = {c})::int' for w in pairs)} as v{c}" for c in range(3))
    return f"""with {EVENT_FLOWS},
s as (select {", ".join(f"avg({f}) as m_{f}, stddev_pop({f}) as s_{f}" for f in names)} from flows),
won as (select user_id, flow_day, copy_no, {", ".join(wins)} from flows, s),
counted as (select *, {votes} from won)
select user_id, flow_day, copy_no, cast(case when v0 >= greatest(v1, v2) then 0
  when v1 >= v2 then 1 else 2 end as int) as prediction from counted"""


def impact() -> str:
    both = f"""with {SCORED},
b as (select {rates()} from (select {counts()} from called where flow_day < '{SPLIT_DAY}')),
s as (select {rates()} from (select {counts()} from called where flow_day >= '{SPLIT_DAY}'))"""
    return both + "\nunion all".join(
        f"""
select '{m}' as metric, b.{m} as baseline, s.{m} as shifted, s.{m} - b.{m} as delta,
  (s.{m} - b.{m}) / (b.{m} + 1e-10::double) * 100.0::double as delta_pct from b, s"""
        for m in ("accuracy", "precision", "recall", "f1"))


SWEEP = f"""with {SCORED},
grid as (select round((i - 30) / 10.0, 1)::double as threshold from range(0, 61) g(i)),
swept as (
  select threshold, {counts("y", "(case when score >= threshold then 1 else 0 end)")}
  from called, grid group by 1)
select threshold, {rates()}, tp, tn, fp, fn from swept"""

MODEL_ROWS = f"""{SCORED},
long as (
  select 'combined' as model, y, p as called from called
  union all select 'resets', y, case when rst >= 2 then 1 else 0 end from called
  union all select 'volume', y, case when len_fwd + len_bwd > 400 then 1 else 0 end from called),
model_rows as (
  select model, {rates()}, tp, tn, fp, fn
  from (select model, {counts("y", "called")} from long group by 1))"""

DISTRIBUTION = """
select {c} as class, count(*) as n,
  count(*)::double / (select count(*) from {t} where {c} is not null) * 100.0::double as pct
from {t} where {c} is not null group by 1"""

BATCH = f"""{EVENT_FLOWS},
batch as (
  select user_id, flow_day, copy_no, rst, len_fwd, len_bwd,
    case when isfinite(bytes_s) then bytes_s end as bytes_s,
    case when isfinite(bytes_s)
      then (0.8::double * rst + 0.004::double * (len_fwd + len_bwd)) - 2.0::double end as decision_score
  from flows),
predicted as (
  select *, case when decision_score > 0 then 'ATTACK' when decision_score is not null
    then 'BENIGN' end as prediction from batch)"""

FOLDS = f"""with {LI},
dealt as (
  select l_returnflag as c, (row_number() over (order by l_returnflag) - 1) % 3 as f from li),
sizes as (select c, f, count(*) as n from dealt group by 1, 2),
ends as (select c, f, sum(n) over (partition by c order by f) as upto from sizes),
ranked as (
  select row_key, l_returnflag, row_number() over (partition by l_returnflag order by {LI_HASH}) as r
  from li)
select row_key, l_returnflag, cast(min(f) as int) as fold
from ranked join ends on c = l_returnflag where r <= upto group by 1, 2"""

SPLIT = f"""with {LI},
sizes as (select l_returnflag as c, count(*)::hugeint as n from li group by 1),
totals as (
  select c, n, sum(n) over ()::hugeint as total,
    (sum(n) over () - ceil((sum(n) over ())::double * 0.2::double))::hugeint as n_train from sizes),
quotas as (select *, (n * n_train) // total as quota, (n * n_train) % total as rest from totals),
turns as (
  select *, n_train - sum(quota) over () as missing,
    row_number() over (order by rest desc, c) as turn from quotas),
ranked as (
  select row_key, l_returnflag, row_number() over (partition by l_returnflag order by {LI_HASH}) as r
  from li)
select row_key, l_returnflag,
  r <= n - quota - case when turn <= missing then 1 else 0 end as is_test
from ranked join turns on c = l_returnflag"""

INVENTORY = " union all ".join(
    f"select {i} as i, '{f}' as feature, '{T.EV_SPEC.notes.get(f, '')}' as description, "
    + (f"count(*) filter (where isfinite({f})) as usable" if f in EV else "null::bigint as usable")
    + " from flows"
    for i, f in enumerate(T.EV_SPEC.features))

ORACLE: dict[str, str] = {
    "flow_label_binary": f"""with {LABELLED_FLOWS}
select user_id, flow_day, copy_no, raw_label, {LABEL} as label from named_flows""",
    "flow_label_multiclass": f"""with {LABELLED_FLOWS}
select user_id, flow_day, copy_no, raw_label, {CATEGORY} as category from named_flows""",
    "flow_coerce": f"""with {EVENT_TEXT}
select event_id, case when isfinite(number) then number end as value,
  coalesce(isinf(number), false) as infinite, number is null as missing from numbers""",
    "flow_dedupe": f"""with {DEDUPED}
select user_id, flow_day, copy_no,
  {", ".join(f"case when isfinite({f}) then {f} end as {f}" for f in EV)},
  coalesce(isinf(bytes_s), false) as bytes_s_infinite, label, original_label, copies
from deduped""",
    "flow_dup_count": f"""with {DEDUPED}
select cast(sum(copies) as bigint) as rows, count(*) as distinct_rows,
  cast(sum(copies) - count(*) as bigint) as duplicates from deduped""",
    "flow_clean": f"with {CLEANED} select {EV_LIST}, label, original_label from cleaned",
    "flow_clean_report": f"""with {CLEANED}
select cast(sum(copies) as bigint) as raw_rows, (select count(*) from cleaned) as cleaned_rows,
  cast(sum(copies) as bigint) - (select count(*) from cleaned) as removed_rows,
  cast(sum(copies) - count(*) as bigint) as duplicates_removed,
  cast(sum({" + ".join(f"coalesce(isinf({f}), false)::int" for f in EV)}) as bigint) as inf_replaced,
  count(*) filter (where not coalesce({USABLE}, false)) as nan_rows_dropped
from deduped""",
    "flow_validation_report": f"""with {CLEANED},
by_class as (select label, count(*) as n from cleaned group by 1)
select cast(sum(copies) as bigint) as raw_rows, (select count(*) from cleaned) as cleaned_rows,
  cast(sum(copies) as bigint) - (select count(*) from cleaned) as removed_rows,
  cast(sum(copies) - count(*) as bigint) as duplicates_removed,
  cast(sum({" + ".join(f"coalesce(isinf({f}), false)::int" for f in EV)}) as bigint) as inf_replaced,
  count(*) filter (where not coalesce({USABLE}, false)) as nan_rows_dropped,
  'len_std' as features_missing, {len(EV)} as num_features,
  (select string_agg(label || '=' || n, ';' order by label) from by_class) as class_distribution,
  (select case when count(*) = 2 then round(max(n)::double / min(n), 2) else 0 end from by_class)
    as imbalance_ratio
from deduped""",
    "class_distribution": f"with {CLEANED}" + DISTRIBUTION.format(c="label", t="cleaned"),
    "class_distribution_items": f"with {LI}" + DISTRIBUTION.format(c="l_returnflag", t="li"),
    "original_class_distribution":
        f"with {CLEANED}" + DISTRIBUTION.format(c="original_label", t="cleaned"),
    "imbalance_ratio": f"""with {CLEANED},
n_of as (select label, count(*) as n from cleaned group by 1)
select count(*) as classes,
  case when count(*) = 2 then max(n)::double / min(n) else 0 end as imbalance_ratio from n_of""",
    "encode_labels": f"""with {LABELLED_FLOWS}
select user_id, flow_day, copy_no, {LABEL} as label,
  cast(case {LABEL} when 'BENIGN' then 0 when 'ATTACK' then 1 end as int) as code, {LABEL} as back
from named_flows""",
    "multiclass_index": f"""with {LABELLED_FLOWS},
ix as (select raw_label as l, row_number() over (order by raw_label) - 1 as code
       from (select distinct raw_label from named_flows where raw_label is not null))
select user_id, flow_day, copy_no, raw_label as original_label, cast(code as int) as code
from named_flows left join ix on l = raw_label""",
    "ablation_projection": f"""with {EVENT_FLOWS}
select user_id, flow_day, copy_no, flow_duration, tot_fwd, tot_bwd, len_fwd, len_bwd, fwd_mean,
  bwd_mean, len_mean, raw_label as y from flows""",
    "feature_inventory": f"""with {EVENT_FLOWS}
select feature, case when usable is null then 'Missing' else 'Available' end as status,
  description, any_value(usable) as usable from ({INVENTORY}) group by all""",
    "validate_records": f"""with {RECORDS}
select event_id, missing = '' and invalid = '' as is_valid, missing, invalid from checked""",
    "table_fingerprint": f"""
select count(*) as rows, substr(sha256(count(*)::varchar || '|' || sum(piece)::varchar), 1, 16)
  as fingerprint
from (select ('0x' || substr(md5({row_text(
    {f: "epoch_us(l_shipdate)" if f == "l_shipdate" else f for f in T.LI_COLUMNS}, T.LI_FEATURES)}),
  1, 15))::bigint::hugeint as piece from lineitem)""",
    "csv_ragged_rows": f"""with {EVENT_FLOWS},
kept as (select user_id::varchar as u, flow_day as d, user_id % 7 as kind,
           user_id || ',' || flow_day as short, tot_fwd::int as t from flows where copy_no = 0)
select case when kind not in (1, 2) then u end as user_id,
  case when kind not in (1, 2) then d end as flow_day,
  case kind when 1 then short || ',' || t || ',surplus' when 2 then short end as line from kept""",
    "csv_mixed_headers": f"""with {EVENT_FLOWS}
select user_id, flow_day, copy_no::bigint as copy_no, flow_duration, tot_fwd, len_fwd, rst,
  case when right(flow_day, 2)::int % 3 <> 2 then ack end as ack, raw_label,
  case when right(flow_day, 2)::int % 3 = 1 then 'x' end as surplus from flows""",
    "training_sample": training_sample(),
    "category_split_sizes": f"""with {CLEANED},
rows_ as (select original_label as raw_label from cleaned),
cats as (select {CATEGORY} as category from rows_),
codes as (select category as c, row_number() over (order by category) - 1 as code
          from (select distinct category from cats)),
{split_sizes("cats", "category")}
select c as category, cast(code as int) as y, is_test, k as n from sides join codes using (c) where k > 0""",
    "binary_split_sizes": f"""with {CLEANED},
{split_sizes("cleaned", "label")}
select cast(c = 'ATTACK' as int) as y, is_test, k as n from sides where k > 0""",
    "pairwise_given": pairwise_given(),
    "svm_objective_given": f"""with {SCORED},
w as (select y, count(*) as n, sum(count(*)) over ()::double / (count(*) over () * count(*)) as weight
      from called group by 1),
m as (select c.y, case when c.y = 1 then 1.0::double else -1.0::double end * score as margin, weight, n
      from called c join w on c.y = w.y),
per as (select y, any_value(n) as n, count(*) filter (where margin <= 1) as inside,
          sum(weight * greatest(0::double, 1::double - margin)) as hinge from m group by 1)
select y, n, inside, round(hinge, 6) as hinge,
  round({T.GIVEN_NORM}::double / 2 + sum(hinge) over (), 6) as objective from per""",
    "pca_two_features": f"""with {LI},
r as (select abs(corr({T.LI_FEATURES[0]}, {T.LI_FEATURES[1]})) as r from li)
select 'pc1' as component, round((1 + r) / 2, 9) as explained, round(sqrt(0.5::double), 9) as a,
  round(sqrt(0.5::double), 9) as b from r
union all select 'pc2', round((1 - r) / 2, 9), round(sqrt(0.5::double), 9), round(sqrt(0.5::double), 9) from r""",
    "csv_scan_clean": f"with {CLEANED} select {EV_LIST}, label, original_label from cleaned",
    "stratified_sample": stratified_sample(LI, "li", "l_returnflag", LI_HASH, SAMPLE, LI_COLS),
    "stratified_sample_flows": stratified_sample(
        f"{EVENT_FLOWS}, named as (select *, {LABEL} as label from flows)", "named", "label",
        "md5(concat_ws('|', '42', user_id, flow_day, copy_no))", 2000,
        "user_id, flow_day, copy_no, label"),
    "topn_sample_per_class": top_n(PER_CLASS, "partition by l_returnflag"),
    "topn_sample": top_n(ANY, ""),
    "shuffled_rows": f"with {LI} select {LI_COLS} from li order by {LI_HASH}",
    "stratified_split": SPLIT,
    "plain_split": f"""with {LI}
select row_key, row_number() over (order by {LI_HASH}) <=
  ceil((select count(*) from li)::double * 0.3::double) as is_test from li""",
    "stratified_folds": FOLDS,
    "class_weights": f"""with {LI}
select l_returnflag as class, count(*) as n,
  (sum(count(*)) over ())::double / (count(*) over () * count(*))::double as weight
from li group by 1""",
    "weighted_rows": f"""with {EVENT_FLOWS},
named as (select user_id, flow_day, copy_no, {LABEL} as raw_label from flows),
w as (select raw_label as c, (sum(count(*)) over ())::double / (count(*) over () * count(*))::double
        as weight from named group by 1)
select user_id, flow_day, copy_no, raw_label, weight from named join w on c = raw_label""",
    "standardize": standardize(),
    "cell_variance": cell_variance(),
    "feature_statistics": statistics(LI, "li", T.LI_FEATURES, 4),
    "feature_statistics_flows": statistics(CLEANED, "cleaned", EV, 3),
    "distribution_compare": comparison(
        LI, "li", T.LI_FEATURES, f"ship_year < {SPLIT_YEAR}", f"ship_year >= {SPLIT_YEAR}"),
    "distribution_compare_tables": comparison(
        CLEANED, "cleaned", EV,
        f"flow_day < '{SPLIT_DAY}'", f"flow_day >= '{SPLIT_DAY}'", 1),
    "perturb_columns": perturbed(),
    "covariance_matrix": covariance(),
    "confusion_binary": f"with {SCORED} select {counts()} from called",
    "metrics_binary":
        f"with {SCORED} select {rates()}, tp, tn, fp, fn from (select {counts()} from called)",
    "metrics_per_day": f"""with {SCORED}
select flow_day, {rates()}, tp, tn, fp, fn
from (select flow_day, {counts()} from called group by 1)""",
    "classification_report": f"""with {PER_CATEGORY}
select class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1,
  cast(support as bigint) as support from full_report
union all select 'accuracy', null, null, round(sum(hits)::double / sum(support), 9),
  cast(sum(support) as bigint) from full_report
union all select 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
  cast(sum(support) as bigint) from full_report
union all select 'weighted avg', round(sum(precision * support) / sum(support), 9),
  round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
  cast(sum(support) as bigint) from full_report""",
    "confusion_multiclass": f"with {CATEGORIES} select truth, predicted, n from cells",
    "confusion_pivot": f"""with {CATEGORIES}
select truth, {", ".join(
    f"cast(coalesce(sum(n) filter (where predicted = '{c}'), 0) as bigint) as {c}"
    for c in ("BENIGN", "Bot", "DDoS"))}
from cells group by 1""",
    "metrics_multiclass": f"""with {PER_CATEGORY}
select round(sum(hits)::double / sum(support), 9) as accuracy, round(avg(f1), 9) as macro_f1,
  round(sum(f1 * support) / sum(support), 9) as weighted_f1 from full_report""",
    "threshold_sweep": SWEEP,
    "drift_impact": impact(),
    "model_compare": f"with {MODEL_ROWS} select * from model_rows",
    "model_compare_best": f"""with {MODEL_ROWS}
select * from model_rows order by f1 desc, list_position(['combined', 'resets', 'volume'], model)
limit 1""",
    "score_batch": f"""with {BATCH}
select p.* replace (case when not isnan(f.bytes_s) then f.bytes_s end as bytes_s)
from predicted p join flows f using (user_id, flow_day, copy_no)""",
    "score_summary": f"""with {BATCH}
select count(*) as total_rows, count(prediction) as valid_rows,
  count(*) - count(prediction) as nan_rows_dropped,
  count(*) filter (where prediction = 'BENIGN') as benign,
  count(*) filter (where prediction = 'ATTACK') as attack from predicted""",
    "permutation_importance": permutation(),
    "artifact_csv": SWEEP,
    "artifact_json":
        f"with {SCORED} select {rates()}, tp, tn, fp, fn from (select {counts()} from called)",
    "experiment_runs": f"""with {SCORED}
select 'EXP-' || flow_day as experiment_id, null::varchar as config,
  '{{"n":' || count(*) || ',"attacks":' || count(*) filter (where y = 1) || '}}' as metrics
from called group by flow_day order by 1""",
    "stream_score": f"""with {RECORDS},
s as (select event_id, (0.05::double * try_cast(amount as double) + 0.02::double * k::double)
        - 3.0::double as decision_score, event_type from records)
select event_id, case when event_type <> 'error' then decision_score end as decision_score,
  case when event_type = 'error' or decision_score is null then null
       when decision_score > 0 then 'ATTACK' else 'BENIGN' end as prediction from s""",
    "stream_score_model": f"""with {RECORDS},
scaled as (
  select event_id, event_type, try_cast(amount as double) is not null as known,
    (k::double - 50.0::double) / 25.0::double as a,
    (try_cast(amount as double) - 30.0::double) / 20.0::double as b from records),
votes as (
  select *, {", ".join(f"case when {c}::double + a * {w[0]}::double + b * {w[1]}::double > 0 then {i} else {j} end as w{i}{j}"
                       for (i, j), (w, c) in T.STREAM_PAIRS.items())} from scaled),
counts as (
  select *, {", ".join(f"((w01 = {i})::int + (w02 = {i})::int + (w12 = {i})::int) as v{i}" for i in range(3))}
  from votes)
select event_id, case when event_type = 'error' or not known then null when v0 >= v1 and v0 >= v2 then 0
  when v1 >= v2 then 1 else 2 end::int as prediction, 'v1' as model_version from counts""",
    "stream_quarantine": f"""with {RECORDS}
select event_id, case when missing = '' and invalid = '' then 'valid' else 'quarantine' end as sink,
  missing, invalid from checked""",
    "stream_drift_windows": """
with b as (select avg(value) as m, stddev_samp(value) as s from events)
select strftime(ts, '%Y-%m-%d') as day, 'value' as feature, count(value) as n,
  round(avg(value), 4) as mean, round(stddev_samp(value), 4) as std,
  round(abs(avg(value) - any_value(m)) / (any_value(s) + 1e-10::double) * 100.0::double, 4)
    as mean_change_pct,
  round(abs(stddev_samp(value) - any_value(s)) / (any_value(s) + 1e-10::double) * 100.0::double, 4)
    as std_change_pct
from events, b group by 1""",
}
ORACLE["top_changed_features"] = f"""
select feature, mean_change_pct from ({ORACLE["distribution_compare_tables"]})
order by mean_change_pct desc, feature limit 3"""

ORACLE["flow_report_observed"] = ORACLE["flow_clean_report"]
ORACLE["score_summary_observed"] = ORACLE["score_summary"]

for _name in ("linear_svm_checked", "logreg_checked", "rf_checked", "rff_svm_checked"):
    ORACLE[_name] = f"""
select *, n as scored, true as consistent from ({ORACLE["binary_split_sizes"]})"""
ORACLE["multiclass_checked"] = f"select *, true as known from ({ORACLE['category_split_sizes']})"
ORACLE["score_csv_checked"] = f"""with {EVENT_FLOWS}
select {USABLE} as has_score, count(*) as n, true as consistent from flows group by 1"""
ORACLE["pca_all_features"] = f"with {LI} " + " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0.0::double as correlation from li"
    for a in T.LI_FEATURES for b in T.LI_FEATURES)
