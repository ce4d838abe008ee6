"""SQL that computes each registered query independently, for DuckDB.

Each statement is a chain of named steps over the given tables; a query lists the step
it ends with, and :func:`_with` writes the steps it needs in order.
"""

from __future__ import annotations

import re

from tidewarden.functions.draws import POISSON_CUTS
from tidewarden.plans.queries import (
    CONTROL_THRESHOLDS,
    DELTA,
    FOLD_OPTIONS,
    OPTIONS,
    PERIOD,
    PROBE_MINUTES,
    PERIOD_SECONDS,
    ROLLING,
    SESSION_GAP_SECONDS,
    SHARDS,
    SHIFT_SPANS,
    STREAM_SPANS,
)
from tidewarden.plans.window_sql import histogram_rows, watched_rows, window_steps, windows
from tidewarden.schema import FEATURES

DOUBLES = (
    "avg_response_time",
    "click_rate",
    "scroll_depth",
    "page_views_per_session",
    "time_between_requests",
)
FLAGS = ("javascript_enabled", "cookies_enabled")


def _u(salt: str) -> str:
    return (
        "(cast('0x'||substr(md5(concat(cast(event_id as varchar),':"
        f"{salt}')),1,8) as bigint)/4294967296.0)"
    )


def _list(values) -> str:
    return "[" + ",".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression},{digits}) as {name}"


def _settled(x: str, name: str) -> str:
    return f"case when abs({x})>=1e6 then round({x},1) when abs({x})>=1e3 then round({x},3) else round({x},6) end as {name}"


_RATES = """
  case when tp+fp>0 then tp/(tp+fp)::double else 0 end as p,
  case when tp+fn>0 then tp/(tp+fn)::double else 0 end as r,
  case when tp+tn+fp+fn>0 then (tp+tn)/(tp+tn+fp+fn)::double else 0 end as a"""
_RATE_COLUMNS = (
    "round(p,6) as precision, round(r,6) as recall, "
    "round(case when p+r>0 then 2*p*r/(p+r) else 0 end,6) as f1, round(a,6) as accuracy"
)
_CELL_SUMS = """
  cast(sum(case when is_bot_pred and is_bot then 1 else 0 end){over} as bigint) as tp,
  cast(sum(case when not is_bot_pred and not is_bot then 1 else 0 end){over} as bigint) as tn,
  cast(sum(case when is_bot_pred and not is_bot then 1 else 0 end){over} as bigint) as fp,
  cast(sum(case when not is_bot_pred and is_bot then 1 else 0 end){over} as bigint) as fn"""


def _vector(values: dict[str, str]) -> str:
    return "[" + ",".join(values[name] for name in FEATURES) + "]"


_FEATURE_SQL = {
    name: f"case when {name} then 1.0::double else 0.0::double end"
    if name in FLAGS
    else f"cast({name} as double)"
    for name in FEATURES
} | {"http_version": "case when http_version='HTTP/2' then 1.0::double else 0.0::double end"}

def _poisson(u: str) -> str:
    cases = " ".join(f"when {u}<{cut!r}::double then {k}" for k, cut in enumerate(POISSON_CUTS))
    return f"case {cases} else {len(POISSON_CUTS)} end"


def _copies(n_models: int) -> str:
    u = (
        "(cast('0x'||substr(md5(concat(cast(event_id as varchar),':',cast(m.model_id as varchar),"
        f"':{OPTIONS.seed}')),1,8) as bigint)/4294967296.0)"
    )
    return (
        f"select event_id, shard, ts, is_bot, x, cast(m.model_id as int) as model_id, "
        f"{_poisson(u)} as k from vec, range({n_models}) m(model_id)"
    )


def _close(x: str, t: str) -> str:
    return "(" + "+".join(
        f"(case when abs({x}[{i}]-{t}[{i}])<0.1::double then 1 else 0 end)" for i in range(1, 15)
    ) + ")"


_GIVEN = (
    "[" + ",".join(
        {0: "(0.4::double+model_id*0.05::double)", 6: "(1-(0.4::double+model_id*0.05::double))"}.get(i, "0.0::double")
        for i in range(14)
    ) + "]"
)
_DOT = "list_sum(list_transform(range(1,15), lambda i: {a}[i]*{b}[i]))"
_G = OPTIONS.grace_period

# name -> SQL; a step may use any other step by name.
STEPS: dict[str, str] = {
    # Sessions of the given events as traffic.
    "cut": f"""select *, sum(fresh) over (partition by user_id order by ts, event_id) as session from (
      select *, case when lag(ts) over w is null or epoch_us(ts)-epoch_us(lag(ts) over w)>={SESSION_GAP_SECONDS * 1_000_000}
        then 1 else 0 end as fresh from events window w as (partition by user_id order by ts, event_id))""",
    "sums": """select user_id, min(event_id) as event_id, max(ts) as ts, count(*) as n, epoch_us(max(ts))-epoch_us(min(ts)) as span,
      sum(cast(value as decimal(18,2)))::double as total, count(props) as with_props,
      count(*) filter (where event_type='view') as views, count(*) filter (where event_type='click') as clicks,
      count(*) filter (where event_type='signup') as signups, count(*) filter (where event_type='error') as wrong,
      count(*) filter (where event_type='purchase') as bought, max(cast(json_extract_string(props, '$.k') as bigint)) as k
      from cut group by user_id, session""",
    "traffic": f"""select event_id, cast(floor({_u('shard')}*{SHARDS}) as int) as shard, ts, concat_ws(':', cast(user_id as varchar), cast(event_id as varchar)) as session_id,
      null::varchar as ip_address, null::varchar as user_agent, bought>0 as is_bot,
      cast(n as int) as requests_per_second, total/n as avg_response_time,
      (views>0)::int+(clicks>0)::int+(signups>0)::int+(wrong>0)::int as unique_endpoints,
      clicks/n as click_rate, views/n as scroll_depth, cast(span//1000000 as int) as session_duration,
      views::double as page_views_per_session, cast(wrong as int) as error_rate,
      case when n>1 then span/(n-1)/1000.0::double else 0 end as time_between_requests, cast(with_props as int) as distinct_headers,
      clicks>0 as javascript_enabled, signups>0 as cookies_enabled, 0 as screen_resolution,
      case when k>=50 then 'HTTP/2' else 'HTTP/1.1' end as http_version from sums""",
    "vec": f"select event_id, shard, ts, is_bot, {_vector(_FEATURE_SQL)} as x from traffic",
    "long": "select event_id, shard, ts, is_bot, i-1 as i, x[i] as v from vec, range(1,15) t(i)",
    "stats": "select shard, i, count(*) as n, avg(v) as mean, coalesce(stddev_samp(v),0) as sd "
    "from long group by shard, i",
    "copies": _copies(OPTIONS.n_models),
    "numbered": "select *, cast(sum(k) over (partition by shard, model_id order by ts, event_id) "
    "as bigint) as trained from copies",
    "samples": f"""select shard, model_id, cast(trained-k+j as bigint)//{_G} as rule_number,
      event_id, x, is_bot from numbered, range(0,13) c(j)
      where j<k and (trained-k+j)%{_G}=0""",
    "newest": "select shard, model_id, max(rule_number) as top from samples group by all",
    "rules": "select s.* from samples s join newest n using (shard, model_id) "
    f"where rule_number>top-{OPTIONS.max_rules}",
    "counts": "select shard, model_id, cast(sum(k) as bigint) as n from copies group by all",
    "moments": """select shard, model_id, i-1 as i, avg(x[i]) as mean,
      coalesce(stddev_samp(x[i]),0) as sd, var_pop(x[i])*count(*) as m2
      from copies, range(0,13) c(j), range(1,15) t(i) where j<k group by all""",
    "given": f"select cast(model_id as int) as model_id, {_GIVEN} as w "
    f"from range({OPTIONS.n_models}) m(model_id)",
    "models": """select shard, model_id, list(mean order by i) as mean, list(sd order by i) as sd,
      list(m2 order by i) as m2 from moments group by all""",
    "sized": """select m.*, w, n, coalesce(r.c,0) as rules from models m join given using (model_id)
      join counts using (shard, model_id)
      left join (select shard, model_id, count(*) as c from rules group by all) r
      using (shard, model_id)""",
    "linear": f"""select event_id, v.shard, ts, is_bot, model_id, {_DOT.format(
        a="list_transform(range(1,15), lambda j: case when sd[j]=0 then 0 else (x[j]-mean[j])/sd[j] end)",
        b="w")} as fs, rules as rule_count from vec v join sized using (shard)""",
    "closeness": f"""select v.event_id, r.model_id, max({_close('v.x', 'r.x')}) as closest,
      sum(case when {_close('v.x', 'r.x')}>=7 then 1 else 0 end) as hits
      from vec v join rules r on v.shard=r.shard group by all""",
    "scores": """select l.*, coalesce(hits,0) as hits, closest,
      case when rule_count=0 then 0.5 when hits>0 then 0.7::double*0.8::double+(1-0.7::double)*fs
      else fs end as score from linear l left join closeness using (event_id, model_id)""",
    "det": f"""select event_id, shard, ts, is_bot, bot_votes, human_votes, vote, confidence,
      vote and confidence>={OPTIONS.threshold}::double as is_bot_pred from (
      select event_id, shard, ts, is_bot,
        cast(sum(case when score>0.7::double then 1 else 0 end) as int) as bot_votes,
        cast(sum(case when score>0.7::double then 0 else 1 end) as int) as human_votes,
        sum(case when score>0.7::double then 1 else -1 end)>0 as vote,
        avg(abs(score-0.5)*2) as confidence from scores group by event_id, shard, ts, is_bot)""",
    "model_acc": """select shard, cast(model_id as bigint) as model_id, count(*) as seen,
      count(*) filter (where (score>0.7::double)=is_bot) as correct,
      count(*) filter (where (score>0.7::double)=is_bot)/count(*)::double as accuracy
      from scores group by shard, model_id""",
    "cells": f"select shard, {_CELL_SUMS.format(over='')} from det group by shard",
    "shard_rates": f"select *, tp+tn+fp+fn as total, case when p+r>0 then 2*p*r/(p+r) else 0 end as f from (select *, {_RATES} from cells)",
    "errors": """select event_id, shard, ts, error, rn as instance_number, errors,
      errors/rn::double as error_rate,
      case when rn>1 then (errors-error)/(rn-1)::double else 0 end as before from (
      select *, cast(case when is_bot_pred<>is_bot then 1 else 0 end as bigint) as error,
        row_number() over w as rn,
        cast(sum(case when is_bot_pred<>is_bot then 1 else 0 end) over w as bigint) as errors
      from det window w as (partition by shard order by ts, event_id))""",
    "blocks": """select shard, (instance_number-1)//32 as block, count(*) as n, sum(error) as errors,
      max(instance_number) as instance_number, max(ts) as ts from errors group by all""",
    "splits": """select *, cast(sum(n) over w as bigint) as n0, cast(sum(errors) over w as bigint) as s0,
      sum(n) over t as total, sum(errors) over t as total_errors from blocks
      window w as (partition by shard order by block), t as (partition by shard)""",
    "cuts": f"""select *, abs(mean0-mean1)>bound as cut from (
      select *, sqrt(2*(1/n0+1/n1)*mu*(1-mu)*ln(2*ln(n0+n1)/{DELTA}::double))
        +2/3::double*(1/n0+1/n1)*ln(2*ln(n0+n1)/{DELTA}::double) as bound from (
      select shard, block, instance_number, ts, n0, cast(total-n0 as bigint) as n1,
        s0/n0::double as mean0, (total_errors-s0)/(total-n0)::double as mean1,
        total_errors/total::double as mu from splits where total>n0))""",
    "shifted": f"""select * replace (
      case when ((epoch_us(ts)-t0)*{_list(SHIFT_SPANS)}[shard%{len(SHIFT_SPANS)}+1]//(t1-t0+1))%2=1
        then not is_bot else is_bot end as is_bot)
      from det, (select epoch_us(min(ts)) as t0, epoch_us(max(ts)) as t1 from det)""",
    "w_errors": """select event_id, shard, ts, error, rn as instance_number, errors, (rn-1)//32 as block from (
      select *, cast(case when is_bot_pred<>is_bot then 1 else 0 end as bigint) as error,
        row_number() over w as rn,
        cast(sum(case when is_bot_pred<>is_bot then 1 else 0 end) over w as bigint) as errors
      from shifted window w as (partition by shard order by ts, event_id))""",
    "w_blocks": """select shard, block, count(*) as n, cast(sum(error) as bigint) as s,
      max(instance_number) as block_end, min(errors-error) as errors_before from w_errors group by all""",
    "w_steps": window_steps("w_steps", reset=True),
    "w_kept_steps": window_steps("w_kept_steps", reset=False),
    "w_windows": windows("w_steps"),
    "w_kept_windows": windows("w_kept_steps"),
    "w_final": """select * from w_steps where not test and not drift
      qualify pos=max(pos) over (partition by shard)""",
    "watched": watched_rows("w_windows"),
    "kept_watched": watched_rows("w_kept_windows"),
    "history": """select shard, instance_number, ts, error_rate, case when drift then 'DRIFT' else 'WARNING' end as type
      from watched where drift or warning_entered""",
    "drift_state": """select w.*, coalesce(warnings,0) as warnings, coalesce(drifts,0) as drifts from (
      select shard, count(*) as checks,
        arg_max(case when drift then 0 else error_rate end, instance_number) as current_error_rate,
        arg_max(case when drift then 0 else window_length end, instance_number) as window_length,
        arg_max(in_warning_zone, instance_number) as in_warning_zone from watched group by shard) w
      left join (select shard, count(*) filter (where type='WARNING') as warnings,
        count(*) filter (where type='DRIFT') as drifts from history group by shard) h using (shard)""",
    "wire": """select *, event_id%97 as kind from traffic""",
    "decoded": f"""select * replace (
      case when kind=5 then null else ts end as ts,
      case when kind=4 then null else is_bot end as is_bot,
      case when kind=3 then null else http_version end as http_version,
      case when kind=6 then null else unique_endpoints end as unique_endpoints)
      from wire where kind not in (0,1,2)""",
    # Exact learning: statistics and rules of every training copy are plain windows; only
    # the weights are carried from copy to copy, by a recursive step.
    "f_copies": _copies(FOLD_OPTIONS.n_models),
    "f_numbered": "select *, cast(sum(k) over (partition by shard, model_id order by ts, event_id) "
    "as bigint) as trained from f_copies",
    "f_steps": "select shard, model_id, cast(trained-k+j as bigint) as c, event_id, x, is_bot "
    "from f_numbered, range(0,13) c(j) where j<k",
    "f_long": """select shard, model_id, c, i-1 as i, x[i] as v, avg(x[i]) over w as mean,
      coalesce(stddev_samp(x[i]) over w,0) as sd from f_steps, range(1,15) t(i)
      window w as (partition by shard, model_id, i order by c)""",
    "f_state": """select shard, model_id, c, list(mean order by i) as mean, list(sd order by i) as sd
      from f_long group by all""",
    "f_rules": f"select shard, model_id, c, x from f_steps where c%{_G}=0",
    "f_hit": f"""select distinct s.shard, s.model_id, s.c from f_steps s join f_rules r
      on s.shard=r.shard and s.model_id=r.model_id and r.c<=s.c
      and r.c//{_G}>s.c//{_G}-{FOLD_OPTIONS.max_rules} where {_close('s.x', 'r.x')}>=7""",
    "f_ready": """select s.shard, s.model_id, s.c, s.x, s.is_bot, h.c is not null as ruled,
      list_transform(range(1,15), lambda j: case when sd[j]=0 then 0
        else (x[j]-mean[j])/sd[j] end) as z
      from f_steps s join f_state using (shard, model_id, c)
      left join f_hit h using (shard, model_id, c)""",
    "f_weights": f"""select shard, model_id, cast(0 as bigint) as c,
        list_transform(range(1,15), lambda i: 1/14::double) as w
      from (select distinct shard, model_id from f_ready) union all
      select shard, model_id, c+1, case when (score>0.7::double)=is_bot then w
        when list_sum(moved)>0 then list_transform(moved, lambda m: m/list_sum(moved))
        else moved end from (
      select *, list_transform(range(1,15), lambda i: greatest(0::double,least(1::double,
        w[i]+(case when is_bot then 1 else -1 end)*abs(x[i]*w[i])*0.01::double))) as moved from (
      select r.shard, r.model_id, r.c, r.x, r.is_bot, f.w, case when r.c=0 then 0.5
        when ruled then 0.7::double*0.8::double+(1-0.7::double)*{_DOT.format(a='z', b='w')}
        else {_DOT.format(a='z', b='w')} end as score
      from f_weights f join f_ready r on f.shard=r.shard and f.model_id=r.model_id and f.c=r.c))""",
    "f_last": """select shard, model_id, c as n, w from f_weights
      qualify c=max(c) over (partition by shard, model_id)""",
    "f_met": """select event_id, shard, model_id, x, is_bot, trained-k as c from f_numbered""",
    "f_met_hit": f"""select distinct m.event_id, m.model_id from f_met m join f_rules r
      on m.shard=r.shard and m.model_id=r.model_id and r.c<m.c
      and r.c//{_G}>(m.c-1)//{_G}-{FOLD_OPTIONS.max_rules} where {_close('m.x', 'r.x')}>=7""",
    "f_scores": f"""select event_id, shard, is_bot, model_id, case when c=0 then 0.5
        when ruled then 0.7::double*0.8::double+(1-0.7::double)*fs else fs end as score from (
      select m.event_id, m.shard, m.is_bot, m.model_id, m.c, h.event_id is not null as ruled,
        {_DOT.format(a="list_transform(range(1,15), lambda j: case when s.sd[j]=0 then 0 else (m.x[j]-s.mean[j])/s.sd[j] end)", b="f.w")} as fs
      from f_met m join f_weights f on m.shard=f.shard and m.model_id=f.model_id and m.c=f.c
      left join f_state s on m.shard=s.shard and m.model_id=s.model_id and s.c=m.c-1
      left join f_met_hit h on h.event_id=m.event_id and h.model_id=m.model_id)""",
    "f_det": f"""select *, vote and confidence>={FOLD_OPTIONS.threshold}::double as is_bot_pred from (
      select event_id, shard, is_bot,
        cast(sum(case when score>0.7::double then 1 else 0 end) as int) as bot_votes,
        cast(sum(case when score>0.7::double then 0 else 1 end) as int) as human_votes,
        sum(case when score>0.7::double then 1 else -1 end)>0 as vote,
        avg(abs(score-0.5)*2) as confidence from f_scores group by event_id, shard, is_bot)""",
}
_RECURSIVE = {"f_weights", "w_steps", "w_kept_steps"}


def _needs(sql: str) -> list[str]:
    return [name for name in STEPS if re.search(rf"\b(from|join)\s*\(?\s*{name}\b", sql) or re.search(rf"\bfrom {name}\b,", sql)]


def _with(sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in _needs(STEPS[name]):
            if needed != name:
                visit(needed)
        ordered.append(name)

    for name in _needs(sql):
        visit(name)
    steps = ",\n".join(f"{name} as materialized ({STEPS[name]})" if name not in _RECURSIVE else f"{name} as ({STEPS[name]})" for name in ordered)
    keyword = "with recursive" if any(n in _RECURSIVE for n in ordered) else "with"
    return f"{keyword} {steps}\n{sql}" if ordered else sql


def _summary(mean: str, m2: str, w: str, version: int, n: str, rules: str, source: str) -> str:
    return (
        f"select shard, model_id, cast({version} as bigint) as version, cast({n} as bigint) as n, "
        f"cast({rules} as bigint) as rules, i-1 as feature_index, {_settled(mean, 'mean')}, "
        f"{_settled(f'sqrt({m2})', 'root_m2')}, round({w},6) as weight from {source}, range(1,15) t(i)"
    )


def _fresh(version: int, n_models: int) -> str:
    return _summary(
        "0::double", "0::double", "1/14::double", version, "0", "0",
        f"(select distinct shard from traffic), (select cast(model_id as int) as model_id from range({n_models}) m(model_id))",
    )


_EVENT_COLUMNS = (
    "event_id, session_id, "
    + ", ".join(f for f in FEATURES if f not in DOUBLES)
    + ", "
    + ", ".join(_r(f, f) for f in DOUBLES)
)


def _band(value: str, good: float, warning: float, low: bool = False) -> str:
    op = "<=" if low else ">="
    return (
        f"case when {value}{op}{good}::double then 'good' "
        f"when {value}{op}{warning}::double then 'warning' else 'danger' end"
    )


def _zeroed(name: str) -> str:
    return f"coalesce({name},0) as {name}"


FINAL: dict[str, str] = {
    "g1_labelled_traffic": "select * exclude (ip_address, user_agent) replace ("
    + ", ".join(f"round({d},6) as {d}" for d in DOUBLES) + ") from traffic",
    "g2_multiplicative_noise": f"""select event_id, {_r('0.2::double*(u-0.5)', 'noise')},
      {_r('avg_response_time*(1+0.2::double*(u-0.5))', 'avg_response_time')},
      {_r('greatest(0,least(1,click_rate*(1+0.2::double*(u-0.5))))', 'click_rate')},
      {_r('greatest(0,least(1,scroll_depth*(1+0.2::double*(u-0.5))))', 'scroll_depth')}
      from (select *, {_u('15')} as u from traffic)""",
    "g3_drift_phases": f"""select epoch, cast(epoch%3 as int) as phase, round(avg(is_bot::int),6) as ratio, count(*) as events,
      count(*) filter (where is_bot) as bots, round(avg(requests_per_second) filter (where is_bot),6) as bot_rps
      from (select *, epoch_us(ts)//{PERIOD_SECONDS * 1_000_000} as epoch from traffic) group by epoch""",
    "g4_session_features": f"""select user_id, min(ts) as session_start, max(ts) as session_end,
      count(*) as events, count(*) filter (where event_type='error') as errors,
      round(sum(value),4) as value_sum,
      round(case when count(*)>1 then (epoch_us(max(ts))-epoch_us(min(ts)))/(count(*)-1)/1000.0 else 0 end,6) as avg_gap_ms,
      round((epoch_us(max(ts))-epoch_us(min(ts)))/1e6,6) as duration_s
      from (select *, sum(fresh) over (partition by user_id order by ts, event_id) as session from (
      select *, case when lag(ts) over w is null or epoch_us(ts)-epoch_us(lag(ts) over w)>={SESSION_GAP_SECONDS * 1_000_000}
        then 1 else 0 end as fresh from events window w as (partition by user_id order by ts, event_id)))
      group by user_id, session""",
    "a2_decode_events": f"select {_EVENT_COLUMNS.replace('unique_endpoints', 'coalesce(unique_endpoints,-1) as unique_endpoints')}, "
    "coalesce(cast(is_bot as varchar),'missing') as is_bot from decoded",
    "a3_apply_defaults": f"select event_id, session_id, "
    "coalesce(date_trunc('millisecond',ts), timestamp '2024-02-01') as ts, "
    + ", ".join(_zeroed(f) if f == "unique_endpoints" else f for f in FEATURES if f not in DOUBLES)
    + ", " + ", ".join(_r(f, f) for f in DOUBLES)
    + ", coalesce(is_bot,false) as is_bot, 0 as metadata_size from decoded",
    "a4_split_bad_records": "select event_id, case kind when 0 then 'unparsable' when 1 then "
    "'null_event' when 2 then 'unparsable' when 3 then 'missing_http_version' else 'good' end as outcome from wire",
    "a5_encode_events": "select session_id as key, session_id, cast(epoch_us(ts)//1000 as varchar) as time, "
    "ip_address as ip, user_agent as agent, cast(requests_per_second as varchar) as rps, "
    "cast(javascript_enabled as varchar) as js, http_version as http, cast(is_bot as varchar) as bot from traffic",
    "a9_model_store": _summary("mean[i]", "m2[i]", "w[i]", 1, "n", "rules", "sized"),
    "b1_feature_vector": "select event_id, "
    + ", ".join(f"round(x[{i + 1}],6) as f{i:02d}" for i in range(14)) + " from vec",
    "b2_feature_names": f"select event_id, i as feature_index, {_list(FEATURES)}[i+1] as feature_name, "
    "round(v,6) as value from long",
    "b3_zscore": "select event_id, l.i as feature_index, "
    "round(case when sd=0 then 0 else (v-mean)/sd end,6) as z from long l join stats using (shard, i)",
    "b4_feature_score": "select event_id, round(sum(case when sd=0 then 0 else (v-mean)/sd end * "
    "case i when 0 then 0.4::double when 6 then 0.6::double else 0 end),6) as feature_score "
    "from long l join stats using (shard, i) group by event_id",
    "b5_rule_match": "select event_id, cast(hits as bigint) as matching_rules, "
    "cast(closest as bigint) as closest from scores where model_id=0",
    "b6_rule_score": "select event_id, case when hits>0 then 0.8::double end as rule_score from scores where model_id=0",
    "b7_blend_score": "select event_id, round(score,6) as score from scores where model_id=0",
    "b8_neutral_score": "select event_id, round(case when shard%2=0 then score else 0.5 end,6) as score "
    "from scores where model_id=0",
    "b9_predict_one": "select event_id, score>0.7::double as bot, round(abs(score-0.5)*2,6) as confidence "
    "from scores where model_id=0",
    "b10_clamp": "select event_id, round(greatest(0,least(1,value/100)),6) as unit, "
    "round(greatest(0.1::double,least(0.7::double,value/100)),6) as ratio from events",
    "b11_status_band": f"select shard, {_band('a', 0.9, 0.7)} as accuracy_band, "
    f"{_band('p', 0.9, 0.7)} as precision_band, {_band('r', 0.85, 0.65)} as recall_band, "
    f"{_band('f', 0.9, 0.7)} as f1_band, {_band('1-a', 0.05, 0.1, True)} as error_band from shard_rates",
    "b12_format_percent": "select shard, printf('%.2f%%',a*100) as accuracy, printf('%.2f%%',p*100) as precision, "
    "printf('%.2f%%',r*100) as recall, round(greatest(0,least(100,f*100)),6) as f1_bar from shard_rates",
    "b13_model_size": "select shard, model_id, cast(rules*100+336 as double) as bytes from sized",
    "b14_event_summary": "select t.event_id, printf('TrafficEvent{session=%s, ip=%s, rps=%d, isBot=%s, confidence=%.2f}',"
    "session_id, coalesce(ip_address,'null'), requests_per_second, cast(t.is_bot as varchar), confidence) as summary "
    "from traffic t join det using (event_id)",
    "c1_detection_threshold": "select event_id, vote, round(confidence,6) as confidence, is_bot_pred from det",
    "c1_untrained_shards": f"""select event_id, case when shard%2=0 then bot_votes else 0 end as bot_votes,
      case when shard%2=0 then human_votes else {OPTIONS.n_models} end as human_votes,
      shard%2=0 and vote as vote, case when shard%2=0 then round(confidence,6) else 0 end as confidence,
      shard%2=0 and is_bot_pred as is_bot_pred from det""",
    "c3_skip_null_event": "select event_id from wire where kind<>1",
    "c4_labelled_only": "select event_id, is_bot from decoded where is_bot is not null",
    "c5_rule_gate": f"select shard, model_id, rule_number*{_G} as seq, is_bot as outcome from rules where model_id%2=0",
    "d1_feature_stats": f"select shard, n, i as feature_index, {_settled('mean', 'mean')}, {_settled('sd', 'sd')} from stats",
    "d1_merge_feature_stats": f"select shard, n, i as feature_index, {_settled('mean', 'mean')}, {_settled('sd', 'sd')} from stats",
    "d2_majority_vote": "select event_id, bot_votes, human_votes, vote from det",
    "d3_mean_confidence": "select event_id, round(confidence,6) as confidence from det",
    "d4_weighted_vote": f"""select event_id, vote, round(confidence,6) as confidence,
      vote and confidence>={OPTIONS.threshold}::double as is_bot_pred from (
      select s.event_id, case when sum(a.accuracy)>0
          then sum(case when score>0.7::double then a.accuracy else 0 end)>sum(case when score>0.7::double then 0 else a.accuracy end)
          else any_value(d.vote) end as vote,
        case when sum(a.accuracy)>0
          then sum(case when score>0.7::double then a.accuracy else 0 end)/sum(a.accuracy)
          else any_value(d.confidence) end as confidence
      from scores s join model_acc a on a.shard=s.shard and a.model_id=s.model_id
      join det d on d.event_id=s.event_id group by s.event_id)""",
    "d5_all_predictions": "select event_id, string_agg(cast(score>0.7::double as varchar), ',' order by model_id) as votes "
    "from scores group by event_id",
    "d6_best_model": "select shard, cast(model_id as int) as model_id from (select *, row_number() over "
    "(partition by shard order by accuracy desc, model_id) as rank from model_acc) where rank=1",
    "d7_worst_model": "select shard, cast(model_id as int) as model_id from (select *, row_number() over "
    "(partition by shard order by accuracy, model_id) as rank from model_acc) where rank=1",
    "d8_model_accuracy_summary": "select shard, round(avg(accuracy),6) as avg_accuracy, round(min(accuracy),6) as min_accuracy, "
    "round(max(accuracy),6) as max_accuracy from model_acc group by shard",
    "d9_confusion_matrix": "select * from cells",
    "d10_precision_recall_f1": "select shard, total as detections, round(p,6) as precision, round(r,6) as recall, round(f,6) as f1 from shard_rates",
    "d11_accuracy": "select count(*) as detections, round(avg(case when is_bot_pred=is_bot then 1.0 else 0 end),6) as accuracy from det",
    "d12_prequential_accuracy": "select shard, count(*) as seen, count(*) filter (where vote=is_bot) as correct, "
    "round(count(*) filter (where vote=is_bot)/count(*)::double,6) as accuracy from f_det group by shard",
    "d12_model_accuracy": "select shard, model_id, seen, correct, round(accuracy,6) as accuracy from model_acc",
    "d13_bot_rate": "select shard, count(*) as events, count(*) filter (where is_bot_pred) as bots, "
    "round(count(*) filter (where is_bot_pred)/count(*)::double,6) as bot_rate, "
    "round(count(*) filter (where is_bot_pred)*100.0/count(*)::double,6) as bot_percent from det group by shard",
    "d14_throughput": "select shard, count(*) as events, epoch_us(max(ts))//1000-epoch_us(min(ts))//1000 as span_ms, "
    "round(count(*)*1000.0/(epoch_us(max(ts))//1000-epoch_us(min(ts))//1000)::double,9) as events_per_second from traffic group by shard",
    "d15_bad_record_rate": "select count(*) as records, count(*) filter (where kind in (0,1,2,3)) as errors, "
    "round(count(*) filter (where kind in (0,1,2,3))/count(*)::double,6) as error_rate from wire",
    "d16_drift_summary": """select shard, checks, warnings, drifts, round(drifts/checks::double,6) as drift_rate,
      round(current_error_rate,6) as current_error_rate, window_length, in_warning_zone from drift_state""",
    "d17_ensemble_report": "select shard, model_id, n as instances, cast(rules as bigint) as depth, "
    "cast(rules*100+336 as double) as bytes from sized",
    "a11_metrics_snapshot": f"""select detections, tp, tn, fp, fn, {_RATE_COLUMNS}, checks, warnings, drifts,
      round(drifts/checks::double,6) as drift_rate, round(current_error_rate,6) as current_error_rate, window_length, in_warning_zone,
      bots, round(bots*100.0/detections::double,6) as bot_percent, round(detections*1000.0/span::double,9) as events_per_second from (
      select *, {_RATES} from (select count(*) as detections, {_CELL_SUMS.format(over='')},
        count(*) filter (where is_bot_pred) as bots,
        epoch_us(max(ts))//1000-epoch_us(min(ts))//1000 as span from shifted),
      (select cast(sum(checks) as bigint) as checks, cast(sum(warnings) as bigint) as warnings, cast(sum(drifts) as bigint) as drifts,
        sum(current_error_rate*window_length)/sum(window_length) as current_error_rate, cast(sum(window_length) as bigint) as window_length,
        count(*) filter (where in_warning_zone) as in_warning_zone from drift_state))""",
    "e1_instance_number": "select event_id, shard, row_number() over (partition by shard order by ts, event_id) as instance_number from traffic",
    "e2_running_feature_stats": "select event_id, row_number() over w as n, "
    + ", ".join(
        f"round(avg(x[{i + 1}]) over w+1e-7::double,3) as mean_{FEATURES[i]}, "
        f"round(coalesce(stddev_samp(x[{i + 1}]) over w,0)+1e-7::double,3) as sd_{FEATURES[i]}"
        for i in (0, 1, 5, 8, 10)
    )
    + " from vec window w as (partition by shard order by ts, event_id rows unbounded preceding)",
    "e3_weighted_instance_number": "select event_id, cast(model_id as bigint) as model_id, trained from numbered",
    "e4_periodic_metrics": f"""select shard, instance_number, event_id, tp, tn, fp, fn, {_RATE_COLUMNS} from (
      select *, {_RATES} from (select shard, event_id, row_number() over w as instance_number,
      {_CELL_SUMS.format(over=' over w')} from det
      window w as (partition by shard order by ts, event_id rows unbounded preceding)))
      where instance_number%{PERIOD}=0""",
    "e5_rule_samples": "select shard, cast(model_id as bigint) as model_id, rule_number, event_id from samples",
    "e6_rule_buffer": "select shard, cast(model_id as bigint) as model_id, rule_number, event_id from "
    "(select s.*, top from samples s join newest using (shard, model_id)) where rule_number>top-5",
    "e7_error_indicator": "select event_id, error, instance_number, round(error_rate,6) as error_rate, window_length, drift from watched",
    "e8_warning_zone": "select event_id, in_warning_zone, warning_entered, warning_left from watched",
    "e8_detection_only": "select event_id, round(error_rate,6) as error_rate, window_length, drift, in_warning_zone, "
    "warning_entered, warning_left from kept_watched",
    "f8_window_histogram": f"select * from ({histogram_rows('w_final')})",
    "e9_recent_drifts": "select shard, instance_number, type, round(error_rate,6) as error_rate from (select *, row_number() over "
    "(partition by shard order by instance_number desc, type desc) as rank from history) where rank<=3",
    "e10_retrain_flag": "select shard, type='DRIFT' as should_retrain from (select *, row_number() over "
    "(partition by shard order by instance_number desc, type desc) as rank from history) where rank=1",
    "e11_time_since_drift": """select shard, epoch_us(as_of)//1000-epoch_us(coalesce(d.ts,first))//1000 as ms_since_drift from (
      select shard, min(ts) as first, max(ts) as as_of from shifted group by shard)
      left join (select shard, max(ts) as ts from history where type='DRIFT' group by shard) d using (shard)""",
    "e12_rolling_metrics": f"""select event_id, instance_number, tp, tn, fp, fn, {_RATE_COLUMNS} from (
      select *, {_RATES} from (select event_id,
      row_number() over (partition by shard order by ts, event_id) as instance_number,
      {_CELL_SUMS.format(over=' over w')} from det
      window w as (partition by shard order by ts, event_id rows between {ROLLING - 1} preceding and current row)))""",
    "e13_metric_evolution": f"""select shard, window_start, tp, tn, fp, fn, {_RATE_COLUMNS} from (
      select *, {_RATES} from (select shard, date_trunc('hour',ts) as window_start,
      {_CELL_SUMS.format(over='')} from det group by shard, date_trunc('hour',ts)))""",
    "a10_drift_history": "select shard, instance_number, type, round(error_rate,6) as error_rate from history",
    "f1_poisson_copies": "select event_id, cast(model_id as bigint) as model_id, cast(k as bigint) as copies from copies",
    "f2_learn_rule": f"select shard, model_id, rule_number*{_G} as seq, is_bot as outcome, "
    + ", ".join(f"round(x[{i + 1}],6) as t{i:02d}" for i in range(14)) + " from rules",
    "f3_adjusted_weights": "select shard, model_id, n, i-1 as feature_index, round(w[i],6) as weight from f_last, range(1,15) t(i)",
    "f4_normalise_weights": "select event_id, i-1 as feature_index, round(case when event_id%50=0 then 0 "
    "else x[i]/list_sum(x) end,6) as w from vec, range(1,15) t(i)",
    "f5_train_step": f"""select l.shard, l.model_id, n, least({FOLD_OPTIONS.max_rules}, (n-1)//{_G}+1) as rules, i as feature_index,
      {_settled('mean', 'mean')}, {_settled('sd', 'sd')} from f_long l join (
      select shard, model_id, max(c)+1 as n from f_steps group by all) t
      on t.shard=l.shard and t.model_id=l.model_id and l.c=t.n-1""",
    "f6_ensemble_prequential": "select shard, model_id, count(*) as seen, "
    "count(*) filter (where (score>0.7::double)=is_bot) as correct from f_scores group by shard, model_id",
    "f7_detect": "select event_id, is_bot_pred, vote, round(confidence,6) as confidence, bot_votes, human_votes from f_det",
    "f9_drift_cut_scan": "select shard, block, n0, n1, round(mean0,6) as mean0, round(mean1,6) as mean1, "
    "round(bound,6) as bound, cut from cuts",
    "f10_drift_response": _summary(
        "case when replaced then 0::double else mean[i] end",
        "case when replaced then 0::double else m2[i] end",
        "case when replaced then 1/14::double else w[i] end",
        1,
        "case when replaced then 0 else n end",
        "case when replaced then 0 else rules end",
        "(select s.*, s.model_id=0 and 1-a>0.06::double as replaced from sized s join shard_rates using (shard))",
    ),
    "f11_reset_state": _fresh(2, OPTIONS.n_models),
    "f12_initial_state": _fresh(0, 10),
}


for _name in ("a9_resume", "a7_stream_batches", "h4_stream_from_saved", "f7_detect_in_segments"):
    FINAL[_name] = FINAL["f7_detect"]
FINAL["a9_stream_detectors"] = FINAL["f3_adjusted_weights"]
FINAL["e4_metrics_in_force"] = f"""select p.event_id, {", ".join(f"coalesce({c},0) as {c}" for c in ("instance_number", "tp", "tn", "fp", "fn", "precision", "recall", "f1", "accuracy"))} from det p asof left join (
  select *, {_RATE_COLUMNS} from (select *, {_RATES} from (select shard, ts, row_number() over w as instance_number,
  {_CELL_SUMS.format(over=' over w')} from det
  window w as (partition by shard order by ts, event_id rows unbounded preceding))
  where instance_number%{PERIOD}=0)) f on p.shard=f.shard and p.ts+interval {PROBE_MINUTES} minutes>=f.ts"""
FINAL["f13_options_in_force"] = f"""select event_id, vote and confidence>=case when epoch_us(ts)>=t0+2*((t1-t0)//3) then {CONTROL_THRESHOLDS[1]}::double
    when epoch_us(ts)>=t0+(t1-t0)//3 then {CONTROL_THRESHOLDS[0]}::double else {FOLD_OPTIONS.threshold}::double end as is_bot_pred,
  vote, round(confidence,6) as confidence, bot_votes, human_votes from f_det join (select event_id, ts from traffic) using (event_id),
  (select epoch_us(min(ts)) as t0, epoch_us(max(ts)) as t1 from traffic)"""
FINAL["a2_variant_metadata"] = """select event_id, user_id, event_type, round(value,4) as value,
  cast(json_extract_string(props, '$.k') as bigint) as k, true as typed from events"""
FINAL["g4_session_vectors"] = "select event_id, shard, is_bot, " + ", ".join(f"round(x[{i + 1}],6) as f{i:02d}" for i in range(14)) + " from vec"
FINAL["f7_detect_sessions"] = FINAL["f7_detect"]
FINAL["f3_session_weights"] = FINAL["f3_adjusted_weights"]
FINAL["f7_session_stream"] = FINAL["f7_detect_sessions"] + f""" join (select event_id as closed from traffic
  where epoch_us(ts)+{SESSION_GAP_SECONDS * 1_000_000}<=(select epoch_us(max(ts)) from events)) on closed=event_id"""
FINAL["a4_stream_outcomes"] = f"""select cast((epoch_us(ts)-t0)*{STREAM_SPANS}//(t1-t0+1) as bigint) as batch, count(*) as records,
  count(*) filter (where kind not in (0,1,2,3)) as good, count(*) filter (where kind=1) as null_event,
  count(*) filter (where kind in (0,2)) as unparsable, count(*) filter (where kind=3) as missing_http_version
  from wire, (select epoch_us(min(ts)) as t0, epoch_us(max(ts)) as t1 from wire) group by 1"""
FINAL["d17_learned_report"] = """select shard, round(avg(accuracy) over (partition by shard),6) as avg_accuracy,
  model_id, n as instances, correct, round(accuracy,6) as accuracy from (
  select shard, model_id, count(*) filter (where (score>0.7::double)=is_bot) as correct,
    count(*) filter (where (score>0.7::double)=is_bot)/count(*)::double as accuracy
  from f_scores group by shard, model_id) join f_last using (shard, model_id)"""


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in FINAL.items()}
