"""The same results in plain SQL, for checking the queries in another engine."""

from __future__ import annotations

from footfall.plans.catalog import DEVICE_TIERS, IP_RANGES, LATE

_TYPES = (
    "'page_view','app_click','search_query','app_download','ad_impression','ad_click','app_install','in_app_purchase'"
)
_HASH = "md5(concat('user_', lpad(cast(user_id as varchar(20)),6,'0'), '_', exp))"


def _bucket(digest: str) -> str:
    return f"(cast('0x' || substr({digest},1,8) as bigint) % 100)"


# The given events as behaviour events.
_ODS = f"""
b as (
  select event_id, cast(ts as timestamp) as ts, user_id, event_type, value,
         cast(json_extract_string(props, '$.k') as int) as k,
         case when event_id % 10 = 9 then ''
              when event_id % 2 = 0 then 'exp_001_home_rec_algo' else 'exp_002_search_ranking' end as exp
  from events),
d as (
  select *, 0 as dup from b
  union all
  select *, 1 as dup from b where event_id % 20 = 0),
ods as (
select
  concat('evt_', cast(event_id as varchar(20))) as event_id,
  case event_type
    when 'view'     then case when k < 70 then 'page_view' else 'ad_impression' end
    when 'click'    then case when k < 60 then 'app_click' else 'ad_click' end
    when 'signup'   then 'app_install'
    when 'purchase' then case when k < 80 then 'app_download' else 'in_app_purchase' end
    else case when k < 50 then 'search_query' else 'error' end end as event_type,
  case when event_id % 97 = 1 then '' when event_id % 89 = 1 then 'null'
       when event_id % 83 = 1 then cast(null as varchar(20))
       else concat('user_', lpad(cast(user_id as varchar(20)),6,'0')) end as user_id,
  concat('device_', lpad(cast((user_id * 3) % 97 as varchar(20)),6,'0')) as device_id,
  ts as event_time,
  ts + interval '1' second * dup as server_time,
  case when event_id % 17 = 0 then null
       else concat('Model ', cast((user_id + k) % 7 as varchar(20))) end as device_model,
  concat('Android ', cast(10 + user_id % 5 as varchar(20))) as os_version,
  case k % 3 when 0 then '8.7.0' when 1 then '8.6.3' else '8.5.0' end as app_version,
  '' as session_id,
  case k % 7 when 0 then 'home' when 1 then 'search' when 2 then 'category' when 3 then 'ranking'
             when 4 then 'detail' when 5 then 'download' else 'mine' end as page,
  concat('10.0.', cast(user_id % 256 as varchar(20)), '.', cast(k as varchar(20))) as ip,
  case when dup = 1 then '广州' when event_id % 13 = 0 then ''
       else case user_id % 5 when 0 then '北京' when 1 then '上海' when 2 then '深圳' when 3 then '成都' else '武汉' end
       end as city,
  case when event_id % 31 = 0 then null else cast(floor(value * 100) as int) end as duration,
  case
    when event_type = 'purchase' and k < 80 and k % 25 = 24 then '{{"download_source":"search"}}'
    when event_type in ('purchase','signup') then concat('{{"app_id":"app_', cast(k % 25 as varchar(20)),
         '","app_name":"App', cast(k % 25 as varchar(20)), '","app_category":"Cat', cast(k % 5 as varchar(20)), '"}}')
    when event_type = 'click' then concat('{{"app_id":"app_', cast(k % 25 as varchar(20)),
         '","app_name":"App', cast(k % 25 as varchar(20)), '","position":', cast(1 + k % 20 as varchar(20)), '}}')
    when event_type = 'error' then concat('{{"keyword":"kw', cast(k % 24 as varchar(20)), '"}}')
    else '{{}}' end as properties,
  'simulator' as source,
  exp as experiment_id,
  case when exp = '' then ''
       when {_bucket(_HASH)} < case when exp = 'exp_001_home_rec_algo' then 50 else 60 end then 'A' else 'B' end
    as variant
from d)"""

_FILLED = """event_id, event_type, user_id, device_id, event_time, server_time,
  coalesce(nullif(device_model,''),'未知') as device_model, os_version, app_version, session_id, page, ip,
  coalesce(nullif(city,''),'未知') as city, coalesce(duration,0) as duration, properties, source,
  experiment_id, variant"""
_VALID = f"user_id is not null and user_id <> '' and user_id <> 'null' and event_type in ({_TYPES})"

# The clean detail, and the stream's form of it that keeps copies.
_DWD = f"""{_ODS},
newest as (select *, row_number() over (partition by event_id order by server_time desc) as rn from ods),
dwd as (select {_FILLED} from newest where rn = 1 and {_VALID}),
live as (select {_FILLED} from ods where {_VALID}),
closed as (select max(event_time) - interval '5' second as until from live)"""


def _q(select: str, **ctes: str) -> str:
    extra = "".join(f",\n{name} as ({text})" for name, text in ctes.items())
    return f"with {_DWD}{extra}\n{select}"


_DAY = "cast(event_time as date)"


def _n(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def _win(seconds: int, time: str = "event_time") -> str:
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({time}) // {us}) * {us})"


def half_up(value: str, digits: int = 2) -> str:
    """Away from zero at the half, on the double."""
    scale = float(10**digits)
    return f"(sign({value}) * floor(abs({value}) * {scale} + 0.5) / {scale})"


def percent(part: str, whole: str, digits: int = 2) -> str:
    """Hundredfold share, 0 of nothing."""
    scale = float(10**digits)
    return (
        f"(case when {whole} > 0 then floor({part} * cast({100.0 * scale} as double) / {whole} + 0.5)"
        f" / cast({scale} as double) else cast(0.0 as double) end)"
    )


def _slide(size: int, step: int, source: str, where: str = "true") -> str:
    """Every row once per window it belongs to."""
    return (
        f"select *, make_timestamp((epoch_us(event_time) // {step * 1_000_000} - i) * {step * 1_000_000}) as window_start "
        f"from {source}, range(0, {-(-size // step)}) r(i) where {where} "
        f"and (epoch_us(event_time) // {step * 1_000_000} - i) * {step} + {size} > epoch(event_time)"
    )


def _end(seconds: int) -> str:
    return f"window_start + interval '{seconds}' second as window_end"


def _traffic(name: str, period: str, by_type: bool = False) -> str:
    rows = f"select *, {period} as p, 'all' as t from dwd"
    if by_type:
        rows += f" union all select *, {period} as p, event_type as t from dwd"
    top = lambda c: (
        f"select p, t, {c} as v from (select p, t, {c}, row_number() over "
        f"(partition by p, t order by count(*) desc, {c}) as r from rows_ group by p, t, {c}) where r = 1"
    )
    avg = "cast(sum(duration) filter (where event_type='page_view') as double) / " + _n("event_type='page_view'")
    return _q(
        f"""select m.p as {name}, m.t as event_type, pv, uv, new_user_count, avg_duration,
  c.v as top_city, e.v as top_device, download_count, search_count
from (select p, t, count(*) as pv, count(distinct user_id) as uv,
        count(distinct case when p = f.first_p then user_id end) as new_user_count,
        case when {_n("event_type='page_view'")} > 0 then {half_up(avg)} else 0.0 end as avg_duration,
        {_n("event_type='app_download'")} as download_count, {_n("event_type='search_query'")} as search_count
      from rows_ join firsts f using (user_id) group by p, t) m
join cities c on c.p = m.p and c.t = m.t join devices e on e.p = m.p and e.t = m.t""",
        rows_=rows,
        firsts="select user_id, min(p) as first_p from rows_ where t = 'all' group by user_id",
        cities=top("city"),
        devices=top("device_model"),
    )


def _retention(ret_days: tuple[int, ...], cohort: str, grid: str | None = None) -> str:
    values = ", ".join(f"({n})" for n in ret_days)
    base = "select user_id, d from days" if cohort == "active" else "select user_id, min(d) as d from days group by user_id"
    bases = grid or "select distinct d from base"
    return _q(
        f"""select g.d as first_date, n.n as ret_day, count(distinct b.user_id) as new_user_count,
  count(distinct r.user_id) as retained_count,
  {percent('count(distinct r.user_id)', 'count(distinct b.user_id)')} as retention_rate
from ({bases}) g cross join (values {values}) n(n)
left join base b on b.d = g.d
left join days r on r.user_id = b.user_id and r.d = g.d + n.n
group by g.d, n.n""",
        days=f"select distinct user_id, {_DAY} as d from dwd",
        base=base,
    )


def _matrix(first: str, last: str, max_n: int) -> str:
    columns = ", ".join(
        f"{percent(f'count(distinct b.user_id) filter (where r.d = b.d + {n})', 'count(distinct b.user_id)')} as day_{n}"
        for n in range(1, max_n + 1)
    )
    return _q(
        f"""select b.d as first_date, count(distinct b.user_id) as new_user_count, {columns}
from days b left join days r on r.user_id = b.user_id and r.d > b.d
where b.d between date '{first}' and date '{last}' group by b.d""",
        days=f"select distinct user_id, {_DAY} as d from dwd",
    )


_AD = ("ad_impression", "ad_click", "app_download", "app_install")
_CONTENT = ("page_view", "app_click", "app_download", "app_install")
_STEP_NAMES = ("impression", "click", "download", "install")


def _step_rows(counts: str) -> str:
    rows = " union all ".join(
        f"""select stat_date, 'app_download_funnel' as funnel_name, {i} as step_order, '{name}' as step_name,
  c{i} as user_count, {percent(f'c{i}', f'c{max(i - 1, 1)}')} as step_rate, {percent(f'c{i}', 'c1')} as overall_rate
from counts"""
        for i, name in enumerate(_STEP_NAMES, start=1)
    )
    return _q(rows, counts=counts)


def _funnel_steps(days: tuple[str, ...] | None = None) -> str:
    counts = ", ".join(
        f"count(distinct case when event_type = '{t}' then user_id end) as c{i}" for i, t in enumerate(_AD, start=1)
    )
    if days is None:
        return _step_rows(f"select {_DAY} as stat_date, {counts} from dwd group by 1")
    grid = ", ".join(f"(date '{d}')" for d in days)
    return _step_rows(
        f"select g.d as stat_date, {counts} from (values {grid}) g(d) left join dwd on {_DAY} = g.d group by 1"
    )


def _funnel_contained() -> str:
    flags = ", ".join(f"max(case when event_type='{t}' then 1 else 0 end) as f{i}" for i, t in enumerate(_CONTENT, 1))
    return _step_rows(
        "select stat_date, count(*) as c1, "
        + ", ".join(f"count(*) filter (where {' and '.join(f'f{j}=1' for j in range(1, k + 1))}) as c{k}" for k in (2, 3, 4))
        + f" from (select {_DAY} as stat_date, user_id, {flags} from dwd group by 1, 2) group by 1"
    )


def _funnel_ordered(hours: int) -> str:
    """From each first step the earliest next steps, each by a nearest-later join; no day is cut off."""
    later = lambda k, before: (
        f"select x.*, y.event_time as t{k} from {before} x asof left join "
        f"(select user_id, event_time from dwd where event_type = '{_AD[k - 1]}') y "
        f"on x.user_id = y.user_id and y.event_time > x.t{k - 1}"
    )
    first = f"(select user_id, event_time as t1, {_DAY} as d from dwd where event_type = '{_AD[0]}')"
    chain = later(4, f"({later(3, f'({later(2, first)})')})")
    counts = ", ".join(
        f"count(distinct case when t{k} <= t1 + interval {hours} hour then user_id end) as c{k}" for k in (2, 3, 4)
    )
    return _step_rows(f"select d as stat_date, count(distinct user_id) as c1, {counts} from ({chain}) group by d")


def _funnel_windowed(source: str = "dwd", where: str = "true") -> str:
    counts = ", ".join(f"{_n(f'event_type={t!r}')} as {n}" for t, n in zip(_AD, _STEP_NAMES))
    rates = ", ".join(f"{percent(n, 'impression')} as {n}_rate" for n in _STEP_NAMES[1:])
    return _q(
        f"select window_start, {_end(600)}, impression, click, download, install, {rates} from counts where {where}",
        counts=f"select {_win(600)} as window_start, {counts} from {source} where event_type in {_AD} group by 1",
    )


def _pv_uv(seconds: int, source: str = "dwd", where: str = "true") -> str:
    return _q(
        f"select * from (select window_start, {_end(seconds)}, count(*) as pv, count(distinct user_id) as uv "
        f"from (select *, {_win(seconds)} as window_start from {source}) group by window_start) where {where}"
    )


def _closed(seconds: int) -> str:
    return f"window_start + interval '{seconds}' second <= (select until from closed)"


_APP = "coalesce(json_extract_string(properties, '$.app_name'), 'unknown')"


def _downloads(size: int, step: int, source: str = "dwd", where: str = "true") -> str:
    return (
        f"select window_start, {_end(size)}, {_APP} as app_name, count(*) as download_count "
        f"from ({_slide(size, step, source, "event_type = 'app_download'")}) "
        f"where {where} group by window_start, app_name"
    )


def _anomaly(seconds: int, source: str = "dwd", value: str = "'all'", up: float | None = None, where: str = "true") -> str:
    surge = "false" if up is None else f"change_rate > {up}"
    return _q(
        f"""select window_start, {_end(seconds)}, dimension_value, current_count, previous_count, change_rate,
  case when change_rate < -0.5 or {surge} then 'ALERT' else 'INFO' end as alert_type,
  case when change_rate < -0.5 then '下载量异常下降！' when {surge} then '下载量异常上升！' else '下载量正常' end as message
from (select *, cast(current_count - previous_count as double) / previous_count as change_rate from compared
      where previous_count > 0)""",
        counts=f"""select * from (select {_win(seconds)} as window_start, {value} as dimension_value,
  count(*) as current_count from {source} where event_type = 'app_download' group by 1, 2) where {where}""",
        compared="""select *, lag(current_count) over (partition by dimension_value order by window_start)
  as previous_count from counts""",
    )


def _rollup() -> str:
    """Closed windows of each length; a longer one is closed once a shorter one behind it is."""
    wide = "max(case when metric_name = '{0}' then metric_value end)"
    named = ", ".join(f"cast({wide.format(n)} as bigint) as {n}" for n in ("pv", "download_count", "search_count", "uv"))
    closed = {
        "5m": "metric_time + interval 5 minute <= (select until from closed_at)",
        "1h": "metric_time + interval 1 hour <= (select max(metric_time) from c5m)",
        "1d": "metric_time + interval 1 day <= (select max(metric_time) from c1h)",
    }
    levels = ", ".join(f"c{w} as (select * from cells where window_size = '{w}' and {rule})" for w, rule in closed.items())
    union = " union all ".join(f"select *, true as is_within from c{w}" for w in closed)
    return (
        f"with closed_at as ({_q('select until from closed')}), metric as ({_realtime()}), "
        f"cells as (select metric_time, window_size, dimension, dimension_value, {named} from metric group by all), "
        f"{levels} {union}"
    )


def _realtime() -> str:
    sizes = {"5m": 300, "1h": 3600, "1d": 86400}
    cells = " union all ".join(
        f"select *, '{dim}' as dimension, {value} as dimension_value from dwd"
        for dim, value in {
            "all": "'all'",
            "app": "json_extract_string(properties, '$.app_name')",
            "city": "city",
            "device_model": "device_model",
        }.items()
    )
    spans = " union all ".join(
        f"select *, '{label}' as window_size, {_win(seconds)} as metric_time from cells where dimension_value is not null"
        for label, seconds in sizes.items()
    )
    values = {
        "pv": "count(*)",
        "uv": "count(distinct user_id)",
        "download_count": _n("event_type='app_download'"),
        "search_count": _n("event_type='search_query'"),
    }
    keys = "metric_time, dimension, dimension_value, window_size"
    return _q(
        " union all ".join(
            f"select metric_time, '{name}' as metric_name, cast({value} as double) as metric_value, dimension, "
            f"dimension_value, window_size from spans group by {keys}"
            for name, value in values.items()
        ),
        cells=cells,
        spans=spans,
    )


_SESSIONS = {
    "gaps": """select *, case when lag(event_time) over w is null
    or event_time - lag(event_time) over w >= interval '30' minute then 1 else 0 end as opens
  from {source} window w as (partition by user_id order by event_time)""",
    "runs": """select *, sum(opens) over (partition by user_id order by event_time
    rows between unbounded preceding and current row) as run from gaps""",
    "spans": """select *, concat('sess_', substr(md5(concat_ws('_', user_id, cast(epoch_us(session_start) as varchar))),1,12))
    as sid from (select *, min(event_time) over (partition by user_id, run) as session_start from runs)""",
}


def _session_query(select: str, source: str = "dwd") -> str:
    return _q(select, **{k: v.replace("{source}", source) for k, v in _SESSIONS.items()})


_SESSION_ROWS = """select sid as session_id, user_id, session_start, max(event_time) as session_end,
  count(*) as event_count from spans group by sid, user_id, session_start"""

_USERS = f"""select {_DAY} as stat_date, experiment_id, variant, user_id, count(*) as events,
  {_n("event_type='app_download'")} as downloads, {_n("event_type='search_query'")} as searches,
  {_n("event_type='app_click'")} as clicks, {_n("event_type='page_view'")} as views,
  cast(sum(duration) filter (where event_type='page_view') as double) as view_ms,
  min(event_time) filter (where event_type='search_query') as first_search,
  max(event_time) filter (where event_type='app_download') as last_download,
  sum(cast(json_extract_string(properties,'$.position') as int)) filter (where event_type='app_click') as position_sum
from dwd where experiment_id <> '' and variant <> '' group by 1, 2, 3, 4"""

_METRICS = [
    ("pv", "cast(sum(events) as double)", "次", "count(*)", "true"),
    ("uv", "cast(count(*) as double)", "人", "count(*)", "true"),
    ("download_count", "cast(sum(downloads) as double)", "次", _n("downloads>0"), "sum(downloads) > 0"),
    ("download_conversion_rate", percent(_n("downloads>0"), "count(*)"), "%", "count(*)", "true"),
    ("search_count", "cast(sum(searches) as double)", "次", _n("searches>0"), "sum(searches) > 0"),
    ("avg_duration", half_up("(sum(view_ms) / sum(views))", 0), "ms", _n("views>0"), "sum(views) > 0"),
]
_FOLLOWED = "searches>0 and first_search < last_download"
_EXTRA = [
    ("app_click_rate", percent(_n("clicks>0"), "count(*)"), "%", "count(*)", "true"),
    ("search_to_download_rate", percent(_n(_FOLLOWED), _n("searches>0")), "%", _n("searches>0"), "sum(searches) > 0"),
    (
        "avg_search_position_clicked",
        half_up("(cast(sum(position_sum) as double) / sum(clicks))"),
        "",
        _n("clicks>0"),
        "sum(clicks) > 0",
    ),
]


def _metric_rows(extra: bool = False) -> str:
    return " union all ".join(
        f"select stat_date, experiment_id, variant, '{name}' as metric_name, {value} as metric_value, "
        f"'{unit}' as metric_unit, {users} as user_count from users group by 1, 2, 3 having {present}"
        for name, value, unit, users, present in (_METRICS + _EXTRA if extra else _METRICS)
    )


def _results(extra: bool = False) -> dict[str, str]:
    pair = "over (partition by stat_date, experiment_id, metric_name)"
    return {
        "users": _USERS,
        "metrics": _metric_rows(extra),
        "paired": f"""select *, max(case when variant='A' then metric_value end) {pair} as a,
  max(case when variant='B' then metric_value end) {pair} as b from metrics""",
        "results": f"""select *, coalesce(case when a > 0 then {half_up('((b - a) / a * 100.0)')} end, 0.0) as uplift
from paired""",
    }


_SAMPLES = " union all ".join(
    f"select stat_date, experiment_id, variant, '{name}' as metric_name, user_id, cast({value} as double) as value "
    f"from users where {where}"
    for name, value, where in [
        ("pv", "events", "true"),
        ("download_count", "downloads", "true"),
        ("search_count", "searches", "true"),
        ("download_conversion_rate", "case when downloads > 0 then 1 else 0 end", "true"),
        ("avg_duration", "view_ms / views", "views > 0"),
    ]
)
_PAIR = "stat_date, experiment_id, metric_name"


def _moments(v: str) -> str:
    f = f"filter (where variant = '{v.upper()}')"
    return (
        f"count(*) {f} as n_{v}, avg(value) {f} as mean_{v}, var_samp(value) {f} as var_{v}, "
        f"coalesce(sum(value) {f}, 0) as ones_{v}"
    )


_TESTS = {
    "users": _USERS,
    "samples": _SAMPLES,
    "stats": f"select {_PAIR}, {_moments('a')}, {_moments('b')}, {_n('value not in (0, 1)')} as other "
    f"from samples group by {_PAIR}",
    "enough": "select * from stats where n_a >= 5 and n_b >= 5",
    "tables": f"""select {_PAIR}, cast(ones_a as bigint) as a, cast(n_a - ones_a as bigint) as b,
  cast(ones_b as bigint) as c, cast(n_b - ones_b as bigint) as d from enough where other = 0""",
}


def _normal_p(z: str) -> str:
    t = f"(1.0::double / (1.0::double + 0.2316419::double * {z}))"
    poly = "1.330274429::double"
    for c in ("-1.821255978", "1.781477937", "-0.356563782", "0.319381530"):
        poly = f"({c}::double + {t} * {poly})"
    return f"least(1.0::double, 2 * (0.3989422804014327::double * exp(-{z} * {z} / 2) * {t} * {poly}))"


_LCHOOSE = "(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - {k} + 1))"


def _log_pmf(x: str) -> str:
    part = lambda n, k: _LCHOOSE.format(n=f"({n})", k=f"({k})")
    return f"({part('a + b', x)} + {part('c + d', f'a + c - {x}')} - {part('a + b + c + d', 'a + c')})"


def _below(density: str, upper: str, rows: str) -> str:
    """``rows`` with ``inside``, the integral of ``density`` of x from 0 to ``upper``, by Simpson's rule."""
    return f"""select {_PAIR}, sum(weight * {density}) * any_value({upper}) / 3000 as inside
from (select *, {upper} * i / 1000 as x, case when i in (0, 1000) then 1.0 when i % 2 = 1 then 4.0 else 2.0 end as weight
      from {rows}, range(0, 1001) r(i)) group by {_PAIR}"""


_STUDENT = "exp(lgamma((v + 1) / 2) - lgamma(v / 2) - ln(v * pi()) / 2 - (v + 1) / 2 * ln(1 + x * x / v))"
_NORMAL = "exp(-x * x / 2) / sqrt(2 * pi())"

_SIGNIFICANCE = {
    **_TESTS,
    "chosen": f"""select *, case when n_a < 5 or n_b < 5 then 'none' when other = 0 then 'fisher'
  when metric_name = 'avg_duration' then 'welch' else 'mann_whitney' end as test from stats""",
    "fishers": f"""select {_PAIR}, least(1.0, sum(case when lp <= observed + ln(1 + 1e-7) then exp(lp) else 0 end)) as p
from (select *, {_log_pmf('x')} as lp, {_log_pmf('a')} as observed from
  (select *, unnest(range(greatest(0, a + c - (c + d)), least(a + b, a + c) + 1)) as x from tables)) group by {_PAIR}""",
    "welches": f"""select {_PAIR}, abs(mean_a - mean_b) / sqrt(va + vb) as t,
  (va + vb) * (va + vb) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) as v
from (select *, var_a / n_a as va, var_b / n_b as vb from chosen where test = 'welch') where va + vb > 0""",
    "ranks": f"""select {_PAIR}, case when spread > 0 then (greatest(u, n_a * n_b - u) - n_a * n_b / 2::double - 0.5) / sqrt(spread) end as z
from (select *, cast(n_a as double) * n_b / 12 * ((n_a + n_b + 1) - ties / (cast(n_a + n_b as double) * (n_a + n_b - 1))) as spread
  from (select {_PAIR}, {_n("variant='A'")} as n_a, {_n("variant='B'")} as n_b,
    sum(case when variant='A' then mid end) - {_n("variant='A'")} * ({_n("variant='A'")} + 1) / 2::double as u,
    sum(cast(t as double) * t - 1) as ties
    from (select *, rank() over (partition by {_PAIR} order by value) + (t - 1) / 2::double as mid
          from (select *, count(*) over (partition by {_PAIR}, value) as t from samples where metric_name <> 'avg_duration'))
    group by {_PAIR}))""",
    "welch_inside": _below(_STUDENT, "t", "welches"),
    "rank_inside": _below(_NORMAL, "z", "(select * from ranks where z is not null)"),
    "p_values": f"""select {_PAIR}, c.n_a, c.n_b, test, case test when 'fisher' then f.p when 'welch' then 1 - 2 * w.inside
  when 'mann_whitney' then case when r.inside is null then 1.0 else least(1.0, 1 - 2 * r.inside) end end as p
from chosen c left join fishers f using ({_PAIR}) left join welch_inside w using ({_PAIR}) left join rank_inside r using ({_PAIR})""",
    "tests": f"""select {_PAIR}, n_a, n_b, test, case when p is null then -1.0 else {half_up('p', 6)} end as p_value,
  case when p < 0.05 then 1 else 0 end as is_significant from p_values""",
}


def _tested(select: str) -> str:
    tested = f"""select r.experiment_id, r.stat_date, variant, r.metric_name, metric_value, metric_unit, user_count,
  coalesce(t.p_value, -1.0) as p_value, coalesce(t.is_significant, 0) as is_significant, uplift, '' as sample_data
from results r left join tests t using ({_PAIR})"""
    return _q(select, **(_results() | _SIGNIFICANCE), tested=tested)


_SIDE_BY_SIDE = (
    "max(case when variant='A' then metric_value end) as a_value, max(case when variant='B' then metric_value end) as b_value"
)


_FUNNEL_METRICS = (*_STEP_NAMES, *(f"{n}_rate" for n in _STEP_NAMES[1:]))


def oracle_sql() -> dict[str, str]:
    user_number = "cast(substr(user_id, 6) as bigint)"
    ranges = ", ".join(f"({_ip_sql(repr(lo))}, {_ip_sql(repr(hi))}, '{c}')" for lo, hi, c in IP_RANGES)
    tiers = ", ".join(f"('{m}', '{t}')" for m, t in DEVICE_TIERS)
    cube = lambda dims, sets: _q(
        "select "
        + ", ".join(f"case when grouping({c}) = 1 then 'all' else {c} end as {c}" for c in dims)
        + f", cast(grouping({', '.join(dims)}) as int) as level, count(*) as pv, count(distinct user_id) as uv, "
        + _n("event_type='app_download'")
        + f" as download_count from dwd group by {sets}({', '.join(dims)})"
    )
    top = lambda where, name: (
        f"select {name} as app_name, count(*) as download_count from dwd where event_type = 'app_download' "
        f"and {where} group by 1 order by download_count desc, app_name nulls first limit 10"
    )
    name_or_null = "json_extract_string(properties, '$.app_name')"
    out = {
        "dwd_clean": _q("select * from dwd"),
        "cleaning_report": _q(
            f"""select (select count(*) from ods) as rows_in, (select count(*) from ods where event_id is null) as rows_without_id,
  (select count(distinct event_id) from ods) as
  rows_deduplicated, (select count(*) from dwd) as rows_valid, (select count(*) from dwd) as rows_out"""
        ),
        "city_from_ip": _q(
            f"""select coalesce(nullif(o.city, ''), r.city, '') as city, count(*) as events
from (select *, {_ip_sql('ip')} as n from ods) o left join (values {ranges}) r(lo, hi, city) on o.n between r.lo and r.hi
group by 1"""
        ),
        "replacing_merge": _q(
            """select event_id, event_time, server_time, city from (select *, row_number() over
  (partition by event_id, event_time order by server_time desc) as r from ods) where r = 1"""
        ),
        "summing_merge": _q(
            """select stat_date, event_type, cast(sum(pv) as bigint) as pv, min_by(first_city, part) as first_city
from parts group by 1, 2""",
            parts=f"""select {_DAY} as stat_date, event_type, hour(event_time) % 2 as part, count(*) as pv,
  min(city) as first_city from dwd group by 1, 2, 3""",
        ),
        "full_refresh": _q("select * from profile", profile=_PROFILE),
        "ttl_filter": _q(
            "select event_id, event_time from dwd where event_time > timestamp '2024-01-31' - interval '7' day"
        ),
        "layer_days": _q(
            f"""select cast({_DAY} as varchar) as dt, count(*) as events, count(distinct user_id) as users from dwd
where {_DAY} between date '2024-01-10' and date '2024-01-20' group by 1"""
        ),
        "jsonl_events": _q(
            "select event_type, count(*) as events, cast(sum(duration) as bigint) as duration_ms from dwd group by 1"
        ),
        "jsonl_rejects": _q(
            """select case when event_type = 'error' then 'rejected' else event_type end as kind, count(*) as lines
from ods group by 1"""
        ),
        "decoded_events": _q(
            """select case when event_type = 'error' then 'rejected' else event_type end as kind, count(*) as messages
from ods group by 1"""
        ),
        "daily_summary": _traffic("stat_date", _DAY),
        "daily_summary_by_type": _traffic("stat_date", _DAY, by_type=True),
        "hourly_summary": _traffic("stat_hour", "date_trunc('hour', event_time)"),
        "new_users": _q(
            f"""select d as stat_date, count(*) as new_user_count
from (select user_id, min({_DAY}) as d from dwd group by 1) group by 1"""
        ),
        "new_users_of_day": _q(
            f"""select distinct user_id from dwd where {_DAY} = date '2024-01-02'
and user_id not in (select user_id from dwd where {_DAY} = date '2024-01-01')"""
        ),
        "top_city_per_day": _q(
            f"""select d as stat_date, city as top_city from (select {_DAY} as d, city, row_number() over
  (partition by {_DAY} order by count(*) desc, city) as r from dwd group by 1, 2) where r = 1"""
        ),
        "drill_down_cube": cube(["city", "device_model", "app_version"], "cube"),
        "drill_down_rollup": cube(["city", "app_version"], "rollup"),
        "city_distribution": _q(
            f"""select city, user_count, {percent('user_count', '(select sum(user_count) from c)')} as user_share from c""",
            c="select city, count(distinct user_id) as user_count from dwd group by 1",
        ),
        "uv_approx": _q(f"select {_DAY} as stat_date, count(distinct user_id) as uv, true as is_within from dwd group by 1"),
        "uv_hll_weekly": _q(
            f"select cast(date_trunc('week', {_DAY}) as date) as week, count(distinct user_id) as uv, true as is_within from dwd group by 1"
        ),
        "uv_bitmap": _q(
            f"select {_DAY} as stat_date, count(distinct {user_number}) as uv from dwd group by 1"
        ),
        "uv_of_sets": _q(f"select {_DAY} as stat_date, count(distinct user_id) as uv from dwd group by 1"),
        "retention_ndays": _retention((1, 3, 7, 30), "active"),
        "retention_base_dates": _retention(
            (1, 3, 7, 30),
            "active",
            "select d from (values (date '2024-01-03'), (date '2024-01-15'), (date '2024-02-15')) v(d)",
        ),
        "retention_new_users": _retention((1, 3, 7, 30), "first_seen"),
        "next_day_retention": _retention((1,), "active"),
        "retention_matrix": _matrix("2024-01-01", "2024-01-14", 14),
        "funnel_steps": _funnel_steps(),
        "funnel_steps_of_days": _funnel_steps(("2024-01-02", "2024-01-15", "2024-03-01")),
        "funnel_contained": _funnel_contained(),
        "funnel_ordered": _funnel_ordered(6),
        "funnel_lookup": f"select step_order, step_name, user_count, step_rate, overall_rate from ({_funnel_steps(('2024-01-15',))})",
        "retention_lookup": _retention((1, 3, 7, 30), "active", "select d from (values (date '2024-01-15')) v(d)"),
        "bitmap_week_uv": _q(
            f"select cast(date_trunc('week', {_DAY}) as date) as week, count(distinct user_id) as uv from dwd group by 1"
        ),
        "bitmap_retention": _retention((1, 3, 7, 30), "active"),
        "bucket_sample": _q("select event_type, count(*) as events from dwd group by 1"),
        "ab_lookup": _q(
            """select experiment_id, stat_date, variant, metric_name, metric_value, metric_unit, user_count,
  cast(-1.0 as double) as p_value, 0 as is_significant, uplift from results
where experiment_id = 'exp_001_home_rec_algo' and stat_date = date '2024-01-15'""",
            **_results(),
        ),
        "realtime_lookup": f"""select cast(coalesce(max(case when alive then pv end), 0) as bigint) as pv,
  cast(coalesce(max(case when alive then uv end), 0) as bigint) as uv
from (select *, window_start + interval 660 second > timestamp '{LATE}' as alive
      from ({_pv_uv(300)}) order by window_start desc limit 1)""",
        "daily_range_lookup": (
            f"select * from ({_traffic('stat_date', _DAY)}) where stat_date between date '2024-01-10' and date '2024-01-20'"
        ),
        "funnel_windowed": _funnel_windowed(),
        "app_conversion": _q(
            f"select *, {percent('download_users', 'click_users')} as conversion_rate from c",
            c=f"""select {_DAY} as stat_date, {name_or_null} as app_name,
  count(distinct case when event_type='app_click' then user_id end) as click_users,
  count(distinct case when event_type='app_download' then user_id end) as download_users
from dwd where event_type in ('app_click','app_download') and {name_or_null} is not null group by 1, 2""",
        ),
        "user_profile": _q("select * from profile", profile=_PROFILE),
        "profile_by_deltas": _q("select * from profile", profile=_PROFILE),
        "profile_report": _q(
            f"""select users, high_active, {percent('high_active', 'users')} as high_active_rate, paying,
  {percent('paying', 'users')} as paying_rate
from (select count(*) as users, {_n("activity_level = '高活跃'")} as high_active, {_n("user_type = '付费用户'")} as paying
      from profile)""",
            profile=_PROFILE,
        ),
        "user_preferences": _q(
            f"""select u.user_id, c.v as preferred_category, s.v as time_slot, e.v as device_model, t.tier as device_tier
from (select distinct user_id from dwd) u left join category c using (user_id) left join slot s using (user_id)
left join device e using (user_id) left join (values {tiers}) t(model, tier) on t.model = e.v""",
            category=_favourite("json_extract_string(properties, '$.app_category')"),
            slot=_favourite(
                "case when hour(event_time) between 5 and 10 then '早' when hour(event_time) between 11 and 16 then '中' "
                "when hour(event_time) between 17 and 22 then '晚' else '深夜' end"
            ),
            device=_favourite("device_model"),
        ),
        "ab_assignment": _q(
            f"""select user_id, experiment_id, bucket, case when bucket < share then 'A' else 'B' end as variant
from (select user_id, e.experiment_id, e.share, {_bucket("md5(concat_ws('_', user_id, e.experiment_id))")} as bucket
      from (select distinct user_id from dwd), (values ('exp_001_home_rec_algo', 50), ('exp_002_search_ranking', 60))
        e(experiment_id, share))"""
        ),
        "ab_dated_assignment": _q(
            f"""select event_id, case when d <= last then e else '' end as experiment_id, case when d > last then ''
  when {_bucket("md5(concat_ws('_', user_id, e))")} < share then 'A' else 'B' end as variant
from (select event_id, user_id, {_DAY} + cast(date '2026-07-10' - date '2024-01-15' as integer) as d,
        cast('0x' || substr(md5(concat_ws('_', '0', event_id)),1,8) as bigint) % 2 as pick from dwd)
join (values (0, 'exp_001_home_rec_algo', date '2026-07-20', 50), (1, 'exp_002_search_ranking', date '2026-07-17', 60))
  x(pick, e, last, share) using (pick)
where d >= date '2026-07-10'
union all select event_id, '', '' from dwd where {_DAY} < date '2024-01-15'"""
        ),
        "ab_event_assignment": _q(
            f"""select event_id, user_id, experiment_id, case when {_bucket("md5(concat_ws('_', user_id, experiment_id))")}
  < case when experiment_id = 'exp_001_home_rec_algo' then 50 else 60 end then 'A' else 'B' end as variant
from (select event_id, user_id, case when cast('0x' || substr(md5(concat_ws('_', '0', event_id)),1,8) as bigint) % 2 = 0
  then 'exp_001_home_rec_algo' else 'exp_002_search_ranking' end as experiment_id from dwd)"""
        ),
        "ab_metrics": _q("select * from metrics", users=_USERS, metrics=_metric_rows()),
        "ab_extra_metrics": _q("select * from metrics", users=_USERS, metrics=_metric_rows(extra=True)),
        "ab_uplift": _q(
            """select experiment_id, stat_date, variant, metric_name, metric_value, metric_unit, user_count,
  cast(-1.0 as double) as p_value, 0 as is_significant, uplift, '' as sample_data from results""",
            **_results(),
        ),
        "ab_samples": _q("select * from samples", users=_USERS, samples=_SAMPLES),
        "ab_pivot": _q(
            """select experiment_id, stat_date, metric_name, metric_unit,
  max(case when variant='A' then metric_value end) as a_value, max(case when variant='B' then metric_value end) as b_value,
  max(uplift) as uplift, '' as marker from results group by 1, 2, 3, 4""",
            **_results(),
        ),
        "ab_significance": _q("select * from tests", **_SIGNIFICANCE),
        "ab_tested_results": _tested("select * from tested"),
        "ab_report": _tested(
            f"""select * from (select {_PAIR}, {_SIDE_BY_SIDE}, max(uplift) as uplift, max(p_value) as p_value,
  max(is_significant) as is_significant from tested group by {_PAIR}) where a_value is not null and b_value is not null"""
        ),
        "ab_pivot_tested": _tested(
            f"""select {_PAIR}, metric_unit, {_SIDE_BY_SIDE}, max(uplift) as uplift,
  case when max(is_significant) = 1 then '✅' when max(p_value) >= 0 then '❌' else '' end as marker
from tested group by {_PAIR}, metric_unit"""
        ),
        "ab_hypothesis": _q(
            """select r.experiment_id, stat_date, r.metric_name, uplift, min_uplift,
  case when uplift >= min_uplift then 1 else 0 end as is_met
from results r join (values ('exp_001_home_rec_algo', 'download_conversion_rate', cast(5.0 as double)),
  ('exp_002_search_ranking', 'search_to_download_rate', cast(8.0 as double))) g(e, m, min_uplift)
on r.experiment_id = g.e and r.metric_name = g.m where variant = 'B'""",
            **_results(extra=True),
        ),
        "ab_ztest": _q(
            f"""select {_PAIR}, n_a, n_b, {half_up('z', 6)} as z, {half_up('p', 6)} as p_value
from (select *, case when se > 0 then {_normal_p('z')} else 1.0 end as p
      from (select *, case when se > 0 then abs(mean_a - mean_b) / se end as z
            from (select *, sqrt(var_a / n_a + var_b / n_b) as se from enough)))""",
            **_TESTS,
        ),
        "ab_fisher": _q(
            f"""select {_PAIR}, a, b, c, d, {half_up('p', 6)} as p_value
from (select {_PAIR}, a, b, c, d, least(1.0, sum(case when lp <= observed + ln(1 + 1e-7) then exp(lp) else 0 end)) as p
      from (select *, {_log_pmf('x')} as lp, {_log_pmf('a')} as observed from
        (select *, unnest(range(greatest(0, a + c - (c + d)), least(a + b, a + c) + 1)) as x from tables))
      group by {_PAIR}, a, b, c, d)""",
            **_TESTS,
        ),
        "ab_chi_square": _q(
            f"""select {_PAIR}, a, b, c, d, {half_up('chi2', 6)} as chi2, {half_up('p', 6)} as p_value
from (select *, {_normal_p('sqrt(chi2)')} as p from
  (select *, case when margins > 0 then (a + b + c + d) * cross_ * cross_ / margins else 0.0::double end as chi2 from
    (select *, cast(a + b as double) * (c + d) * (a + c) * (b + d) as margins, cast(a * d - b * c as double) as cross_
     from tables)))""",
            **_TESTS,
        ),
        "ab_mann_whitney_u": _q(
            f"""select {_PAIR}, n_a, n_b, u as u_statistic, ties as tie_term, {half_up(
                'case when spread > 0 then (greatest(u, n_a * n_b - u) - n_a * n_b / 2::double - 0.5) / sqrt(spread) end', 6
            )} as z
from (select *, cast(n_a as double) * n_b / 12 * ((n_a + n_b + 1) - ties / (cast(n_a + n_b as double) * (n_a + n_b - 1)))
        as spread
      from (select {_PAIR}, {_n("variant='A'")} as n_a, {_n("variant='B'")} as n_b,
              sum(case when variant='A' then mid end) - {_n("variant='A'")} * ({_n("variant='A'")} + 1) / 2::double as u,
              sum(cast(t as double) * t - 1) as ties
            from (select *, rank() over (partition by {_PAIR} order by value) + (t - 1) / 2::double as mid
                  from (select *, count(*) over (partition by {_PAIR}, value) as t from samples
                        where metric_name <> 'avg_duration'))
            group by {_PAIR}) where n_a >= 5 and n_b >= 5)""",
            **_TESTS,
        ),
        "ab_welch_stat": _q(
            f"""select stat_date, experiment_id, n_a, n_b, {half_up('t', 6)} as t_statistic, {half_up('v', 4)} as degrees
from (select *, case when va + vb > 0 then (mean_a - mean_b) / sqrt(va + vb) end as t,
        case when va + vb > 0 then (va + vb) * (va + vb) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) end as v
      from (select *, var_a / n_a as va, var_b / n_b as vb from stats
            where metric_name = 'avg_duration' and n_a > 1 and n_b > 1))""",
            **_TESTS,
        ),
        "pv_uv_5m": _pv_uv(300),
        "pv_uv_sliding_uneven": _q(
            f"""select window_start, {_end(300)}, count(*) as pv, count(distinct user_id) as uv
from ({_slide(300, 120, 'dwd')}) group by window_start"""
        ),
        "downloads_sliding_uneven": _q(_downloads(420, 180)),
        "latest_snapshot": _q(
            """select 'download_count' as metric_name, 'app' as dimension, app_name as dimension_value, '1d' as window_size,
  window_start as metric_time, cast(download_count as double) as metric_value, window_start + interval 40 day as expires_at
from (select *, row_number() over (partition by app_name order by window_start desc) as r from x) where r = 1""",
            x=_downloads(86400, 86400),
        ),
        "pv_uv_sliding": _q(
            f"""select window_start, {_end(300)}, count(*) as pv, count(distinct user_id) as uv
from ({_slide(300, 30, 'dwd')}) group by window_start"""
        ),
        "downloads_sliding": _q(_downloads(300, 60)),
        "download_ranking": _q(
            """select * from (select *, cast(row_number() over (partition by window_start
  order by download_count desc, app_name) as int) as rank from x) where rank <= 5""",
            x=_downloads(21600, 3600),
        ),
        "realtime_metrics": _realtime(),
        "metric_rows": _q(
            f"""select window_start as metric_time, 'pv' as metric_name, cast(count(*) as double) as metric_value,
  'all' as dimension, 'all' as dimension_value, '1h' as window_size
from (select *, {_win(3600)} as window_start from dwd) group by 1
union all select window_start, 'uv', cast(count(distinct user_id) as double), 'all', 'all', '1h'
from (select *, {_win(3600)} as window_start from dwd) group by 1"""
        ),
        "pv_uv_messages": _q(
            f"""select concat('{{"metric":"pv_uv","pv":', count(*), ',"uv":', count(distinct user_id), ',"window_time":"',
  strftime(window_start + interval '1' hour, '%Y-%m-%d %H:%M:%S'), '"}}') as value
from (select *, {_win(3600)} as window_start from dwd) group by window_start"""
        ),
        "latest_values": _q(
            f"""select metric_name, 'all' as dimension, 'all' as dimension_value, '5m' as window_size, w as metric_time,
  metric_value, w + interval '660' second as expires_at
from (select w, cast(count(*) as double) as pv, cast(count(distinct user_id) as double) as uv
      from (select *, {_win(300)} as w from dwd) group by 1 order by 1 desc limit 1)
unpivot (metric_value for metric_name in (pv, uv))"""
        ),
        "sessions": _session_query(_SESSION_ROWS),
        "events_with_sessions": _session_query("select event_id, user_id, event_time, sid as session_id from spans"),
        "download_anomaly": _anomaly(21600),
        "download_surge_per_app": _anomaly(86400, value=_APP, up=0.8),
        "anomaly_3down": _q(
            f"""select window_start, {_end(3600)}, 'all' as dimension_value, c3 as from_count, c as current_count,
  cast(c - c3 as double) / c3 as total_change
from (select *, lag(c, 1) over w as c1, lag(c, 2) over w as c2, lag(c, 3) over w as c3
      from (select {_win(3600)} as window_start, count(*) as c from dwd where event_type = 'app_download' group by 1)
      window w as (order by window_start))
where c < c1 and c1 < c2 and c2 < c3 and cast(c - c3 as double) / c3 < -0.6"""
        ),
        "stream_clean": _q(
            "select event_id, event_type, user_id, event_time, device_model, duration from dwd"
        ),
        "stream_clean_newest": _q(
            "select * from dwd where event_time < (select until from closed)"
        ),
        "stream_realtime_tables": f"""select window_start as metric_time, metric_name, metric_value, 'all' as dimension,
  'all' as dimension_value, '5m' as window_size from (select window_start, cast(pv as double) as pv, cast(uv as double) as uv
  from ({_pv_uv(300, "dwd", _closed(300))})) unpivot (metric_value for metric_name in (pv, uv))
union all select window_start, 'download_count', cast(download_count as double), 'app', app_name, '5m'
from ({_q(_downloads(300, 60, "dwd", _closed(300)))})
union all select window_start, metric_name, metric_value, 'all', 'all', '10m' from (select window_start,
  {", ".join(f"cast({n} as double) as {n}" for n in _FUNNEL_METRICS)} from ({_funnel_windowed("dwd", _closed(600))}))
  unpivot (metric_value for metric_name in ({", ".join(_FUNNEL_METRICS)}))""",
        "stream_daily": _q(
            f"""select {_DAY} as stat_date, count(*) as pv, count(distinct user_id) as uv,
  {_n("event_type='app_download'")} as download_count, {_n("event_type='search_query'")} as search_count from live group by 1"""
        ),
        "stream_pv_uv": _pv_uv(300, "dwd", _closed(300)),
        "stream_downloads": _q(_downloads(300, 60, "dwd", _closed(300))),
        "stream_funnel": _funnel_windowed("dwd", _closed(600)),
        "stream_sessions": _session_query(
            f"select * from ({_SESSION_ROWS}) where session_end + interval '1799999999' microsecond "
            "<= (select until from closed)",
            "dwd",
        ),
        "stream_pv_uv_sliding": _q(
            f"""select window_start, {_end(300)}, count(*) as pv, count(distinct user_id) as uv
from ({_slide(300, 5, 'dwd')}) where {_closed(300)} group by window_start"""
        ),
        "stream_download_ranking": _q(
            """select * from (select *, cast(row_number() over (partition by window_start
  order by download_count desc, app_name) as int) as rank from x) where rank <= 5""",
            x=_downloads(21600, 3600, where=_closed(21600)),
        ),
        "stream_realtime_metrics": _rollup(),
        "stream_anomaly": _anomaly(21600, "dwd", where=_closed(21600)),
        "stream_followed": _q(
            """select event_id, user_id, event_time from (select distinct event_id, user_id, event_time from live
  where event_type = 'app_click') a where exists (select 1 from live b where b.event_type = 'app_download'
  and b.user_id = a.user_id and b.event_time > a.event_time and b.event_time <= a.event_time + interval '6' hour)"""
        ),
        "stream_late_rows": _q(
            """select cast(event_time as date) as stat_date, is_late, count(*) as events, cast(sum(duration) as bigint) as duration_ms
from (select x.*, coalesce(event_time < (select max(event_time) from parts p where p.part < x.part) - interval '5' second, false) as is_late
  from parts x) group by 1, 2""",
            parts="""select *, least(case when day(event_time) <= 10 then 0 when day(event_time) <= 20 then 1 else 2 end
  + case when hour(event_time) = 3 then 1 else 0 end, 2) as part from ods""",
        ),
        "top_downloads": _q(
            top("event_time >= timestamp '2024-01-24' and event_time < timestamp '2024-02-01'", f"coalesce({name_or_null}, '')")
        ),
        "top_downloads_of_day": _q(top(f"{_DAY} = date '2024-01-15'", name_or_null)),
        "sample_users": _q(
            """select user_id from (select distinct user_id from dwd) order by md5(concat_ws('_', '7', user_id)), user_id
limit 50"""
        ),
        "kpi_snapshot": _q(
            f"""select {_n('recent')} as pv, count(distinct case when recent then user_id end) as uv,
  {_n("today and event_type='app_download'")} as download_count, {_n("today and event_type='search_query'")} as search_count
from (select *, event_time > n - interval '60' minute and event_time <= n as recent,
        event_time >= date_trunc('day', n) and event_time <= n as today
      from dwd, (select timestamp '2024-01-20 12:00:00' as n))"""
        ),
        "daily_trend": _q(
            f"""select {_DAY} as stat_date, count(*) as pv, count(distinct user_id) as uv from dwd
where {_DAY} between date '2024-01-13' and date '2024-01-20' group by 1"""
        ),
        "hourly_trend": _q(
            """select date_trunc('hour', event_time) as stat_hour, count(*) as pv, count(distinct user_id) as uv from dwd
where event_time >= timestamp '2024-01-19 12:00:00' and event_time < timestamp '2024-01-20 12:00:00' group by 1"""
        ),
    }
    return out


def _ip_sql(ip: str) -> str:
    part = lambda i: f"cast(split_part({ip}, '.', {i}) as bigint)"
    return f"({part(1)} * 16777216 + {part(2)} * 65536 + {part(3)} * 256 + {part(4)})"


def _favourite(value: str) -> str:
    return (
        f"select user_id, v from (select user_id, {value} as v, row_number() over "
        f"(partition by user_id order by count(*) desc, {value}) as r from dwd where {value} is not null group by 1, 2) "
        "where r = 1"
    )


_PROFILE = f"""select user_id,
  case when total_events >= 100 then '高活跃' when total_events >= 30 then '中活跃' when total_events >= 5 then '低活跃'
    else '沉睡用户' end as activity_level,
  case when purchases > 0 then '付费用户' when downloads > 0 then '下载型用户' when searches > 2 then '搜索型用户'
    else '浏览型用户' end as user_type,
  total_events, active_days, downloads, searches, purchases, t.v as device_model, first_seen, last_seen
from (select user_id, count(*) as total_events, count(distinct {_DAY}) as active_days,
        {_n("event_type='app_download'")} as downloads, {_n("event_type='search_query'")} as searches,
        {_n("event_type='in_app_purchase'")} as purchases, min(event_time) as first_seen, max(event_time) as last_seen
      from dwd group by user_id) join ({_favourite('device_model')}) t using (user_id)"""
