"""SQL for the adaptive window: one step adds a block to the histogram or drops its oldest bucket.

The histogram is a column for each level, a list of buckets (n, s), newest first.
"""

from __future__ import annotations

from tidewarden.plans.queries import DELTA, OPTIONS

LEVELS = 16
_NAMES = [f"l{k}" for k in range(LEVELS)]
_ALL = f"list_concat({', '.join(_NAMES)})"
_BUCKETS = "struct(n bigint, s bigint)[]"
_N = f"cast(coalesce(list_sum(list_transform({_ALL}, lambda b: b.n)),0) as bigint)"
_S = f"cast(coalesce(list_sum(list_transform({_ALL}, lambda b: b.s)),0) as bigint)"
# Whether two sides of some bucket border differ by more than the bound, and have five rows each.
_DISAGREE = f"""(len(list_filter(list_transform(range(1, len(o)), lambda i: struct_pack(
    n0:=list_sum(list_transform(o[1:i], lambda b: b.n)), s0:=list_sum(list_transform(o[1:i], lambda b: b.s)))),
    lambda c: c.n0>=5 and n-c.n0>=5 and abs(c.s0/c.n0-(s-c.s0)/(n-c.n0)) >
      sqrt(2*(1/c.n0+1/(n-c.n0))*(s/n)*(1-s/n)*ln(2*ln(n)/{DELTA}::double))
      +2/3::double*(1/c.n0+1/(n-c.n0))*ln(2*ln(n)/{DELTA}::double)))>0)"""


def _replaced(columns: list[str], source: str) -> str:
    return f"(select * replace ({', '.join(columns)}) from {source})"


def window_steps(table: str, reset: bool) -> str:
    """Body of the recursive ``table``: (shard, pos, test, drift, width n, errors s, the same before the block, levels)."""
    answered = f"not test and drift and {str(reset).lower()}"
    cleared = ", ".join(f"case when {answered} then cast([] as {_BUCKETS}) else {name} end as {name}" for name in _NAMES)
    # a tested window that disagreed loses a bucket; otherwise the next block comes in
    taken = f"""(select f.shard, case when test then f.pos else b.block end as pos, not test as adding, b.n as bn, b.s as bs,
        b.n=32 as full_block, drift as earlier_drift, drift_before as kept_before, n_before as kept_n, s_before as kept_s, {cleared}
      from {table} f join w_blocks b on b.shard=f.shard and b.block=case when test then f.pos else f.pos+1 end)"""
    moved = f"""(select shard, pos, adding, full_block, bn, bs, not adding as drift,
        case when adding then earlier_drift else kept_before end as drift_before, {', '.join(_NAMES)},
        case when adding then {_N} else kept_n end as n_before, case when adding then {_S} else kept_s end as s_before from {taken})"""
    state = _replaced(["case when adding then list_concat([struct_pack(n:=bn, s:=bs)], l0) else l0 end as l0"], moved)
    for low, high in zip(_NAMES, _NAMES[1:]):
        joined = f"struct_pack(n:={low}[5].n+{low}[6].n, s:={low}[5].s+{low}[6].s)"
        state = _replaced(
            [
                f"case when len({low})>5 then {low}[1:4] else {low} end as {low}",
                f"case when len({low})>5 then list_concat([{joined}], {high}) else {high} end as {high}",
            ],
            state,
        )
    dropped = []
    for k, name in enumerate(_NAMES):
        oldest = " and ".join(["not adding", f"len({name})>0", *[f"len({above})=0" for above in _NAMES[k + 1 :]]])
        dropped.append(f"case when {oldest} then {name}[1:len({name})-1] else {name} end as {name}")
    state = _replaced(dropped, state)
    empty = ", ".join(f"cast([] as {_BUCKETS}) as {name}" for name in _NAMES)
    zeros = ", ".join(f"cast(0 as bigint) as {name}" for name in ("n", "s", "n_before", "s_before"))
    return f"""select shard, cast(-1 as bigint) as pos, false as test, false as drift, false as drift_before, {zeros}, {empty}
      from (select distinct shard from w_blocks) union all
      select shard, pos, case when n>10 and s>0 and s<n and full_block then {_DISAGREE} else false end as test,
        drift, drift_before, n, s, n_before, s_before, {', '.join(_NAMES)} from (
      select *, list_reverse({_ALL}) as o, {_N} as n, {_S} as s from {state})"""


def windows(steps: str) -> str:
    return f"""select shard, pos as block, n as width, s as window_errors, drift, drift_before, n_before as width_before, s_before
      from {steps} where not test and pos>=0"""


def watched_rows(source: str) -> str:
    level = f"{OPTIONS.warning_level}::double"
    return f"""select *, zone as in_warning_zone, zone and not was as warning_entered, not zone and was and not drift as warning_left from (
      select *, not drift and error_rate>{level} as zone, case when at_end then width else whole end as window_length,
        case when whole>1 then earlier/(whole-1) else 0 end>{level} and not (place=1 and drift_before) as was from (
      select e.event_id, e.shard, e.ts, e.error, e.instance_number, b.block_end=e.instance_number as at_end, w.drift_before, width,
        width_before+e.instance_number-e.block*32 as whole, e.instance_number-e.block*32 as place,
        s_before+e.errors-b.errors_before-e.error as earlier, b.block_end=e.instance_number and w.drift as drift,
        case when b.block_end=e.instance_number then window_errors/width
          else (s_before+e.errors-b.errors_before)/(width_before+e.instance_number-e.block*32) end as error_rate
      from w_errors e join w_blocks b using (shard, block) join {source} w using (shard, block)))"""


def histogram_rows(source: str) -> str:
    return " union all ".join(
        f"select shard, {k} as level, i-1 as place, {name}[i].n as n, {name}[i].s as errors "
        f"from {source}, range(1,7) t(i) where i<=len({name})"
        for k, name in enumerate(_NAMES)
    )
