"""SQL fragments shared by the oracles."""

from __future__ import annotations

from wattsift.plans.energy_view import raw_energy_sql
from wattsift.profile import DEFAULT_WEIGHTS, ENERGY

P = ENERGY
ADJUSTED, BRUT = P.ratios


def draw(seed: int, purpose: str, *parts: str) -> str:
    text = ", ".join([f"'{seed}'", f"'{purpose}'", *[f"cast({p} as varchar)" for p in parts]])
    return f"cast(('0x' || substr(md5(concat_ws(':', {text})), 1, 13)) as bigint)"


def number(column: str) -> str:
    """Text to double; unreadable text is null."""
    t = f"trim({column})"
    plain = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return (
        f"case when regexp_full_match({t}, '{plain}') then try_cast({t} as double)"
        f" when regexp_full_match(lower({t}), '[+-]?(inf|infinity)')"
        f" then case when {t} like '-%' then cast('-inf' as double) else cast('inf' as double) end end"
    )


def total(columns: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"coalesce({c}, cast(0 as double))" for c in columns) + ")"


def flag(columns: tuple[str, ...]) -> str:
    return f"(abs(round_even({total(columns)} * 10000, 0) / 10000 - 100) <= cast(0.1 as double))"


def usable(columns: tuple[str, ...]) -> str:
    complete = " and ".join(f"{c} is not null and {c} >= 0" for c in columns)
    return f"coalesce({complete} and abs({total(columns)} - 100) <= cast(0.1 as double) + cast(0.00001 as double) * 100, false)"


def close(a: str, b: str) -> str:
    return f"coalesce(abs({a} - {b}) <= cast(1e-8 as double) + cast(1e-5 as double) * abs({b}), false)"


CONTEXT = "concat_ws(chr(31), " + ", ".join(f"coalesce('v' || {c}, 'n')" for c in P.context) + ")"

RAW = f"raw as ({raw_energy_sql()})"

_TYPED = ", ".join(
    [f"{number(c)} as {c}" for c in P.ratios]
    + [f'"{c[:-4]}_%" as {c}' for c in P.splits + P.shares]
    + [f"cast({c} as double) as {c}" for c in P.counts]
)
KEPT = (P.year, P.occupation, *P.context[:2])

CLEAN = f"""{RAW},
typed as (select source_row_id, {", ".join(KEPT)}, {_TYPED} from raw where {P.year} is distinct from '2010-2019'),
clean as (select *, {flag(P.shares)} as {P.shares_valid}, {flag(P.splits)} as {P.splits_valid},
 coalesce({P.occupation} = '1A', false) as {P.mono_flag}, {ADJUSTED} - {BRUT} as {P.delta},
 {total(P.shares)} as {P.shares_sum}, {total(P.splits)} as {P.splits_sum} from typed)"""


def rounded(columns: tuple[str, ...], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)


# ---- shared by the injection oracles ----

ALLOCATED = f"""weights(pos, name, w) as (values {", ".join(f"({i}, '{n}', cast({w} as double))" for i, (n, w) in enumerate(DEFAULT_WEIGHTS.items()))}),
exact as (select pos, name, w * wanted as x, wanted from weights, wanted),
floors as (select pos, name, wanted, floor(x) as base, row_number() over (order by floor(x) - x, pos) as nth,
 sum(floor(x)) over () as given from exact),
alloc as (select pos, name, cast(base + case when nth <= wanted - given then 1 else 0 end as bigint) as n from floors),
ends as (select name, n, sum(n) over (order by pos) as hi, sum(n) over (order by pos) - n as lo from alloc)"""

MEANS = f"""usable_rows as (select *, {CONTEXT} as ctx, {usable(P.shares)} as ok_mix, {usable(P.splits)} as ok_split from clean),
ctx_wide as (select ctx, count(*) filter (where ok_mix) as usable_rows,
 {", ".join(f"avg({c}) filter (where ok_mix) as m{i}" for i, c in enumerate(P.shares))} from usable_rows group by ctx),
all_wide as (select {", ".join(f"avg({c}) filter (where ok_mix) as m{i}" for i, c in enumerate(P.shares))} from usable_rows),
ctx_means as ({" union all ".join(f"select ctx, usable_rows, {i} as pos, case when usable_rows > 0 then c.m{i} else a.m{i} end as mean from ctx_wide c, all_wide a" for i in range(len(P.shares)))}),
ctx_top as (select *, row_number() over (partition by ctx order by round(mean, 9) desc, pos) = 1 as top from ctx_means),
ctx_order as (select ctx, pos, mean, usable_rows, row_number() over (partition by ctx order by top, round(mean, 9), pos) as nth from ctx_top)"""

TARGETS = f"""wanted as (select cast(round_even(count(*) * cast(0.05 as double), 0) as bigint) as wanted from clean),
{ALLOCATED},
ranked as (select *, row_number() over (order by {draw(42, "target", "source_row_id")}, source_row_id) as place
 from usable_rows where {P.shares_valid} and {P.splits_valid}),
targets as (select r.*, e.name as anomaly_type from ranked r join ends e on r.place > e.lo and r.place <= e.hi)"""

TAILS = f"""tail_order as (select source_row_id, row_number() over (order by {ADJUSTED}, source_row_id) as rn, count(*) over () as m
 from usable_rows where {ADJUSTED} is not null and {BRUT} is not null),
tails as (select source_row_id, rn <= greatest(1, m // 10) as low from tail_order
 where rn <= greatest(1, m // 10) or rn > m - greatest(1, m // 10))"""


def _list(columns: tuple[str, ...]) -> str:
    return "[" + ", ".join(columns) + "]"


_MONO = f"case when {P.mono_flag} then 'mono' else 'multi' end"

INJECT = f"""{CLEAN},
{MEANS},
{TARGETS},
{TAILS},
pool as (
 select 'tail' as pool, ctx, source_row_id as donor_id, {_list(P.ratios)} as vals from usable_rows semi join tails using (source_row_id)
 union all select 'mix', ctx, source_row_id, {_list(P.shares)} from usable_rows where ok_mix
 union all select {_MONO}, ctx, source_row_id, {_list(P.splits)} from usable_rows where ok_split),
placed as (select *, row_number() over (partition by pool order by {draw(42, "context", "ctx")}, ctx, {draw(42, "pool", "donor_id")}, donor_id) - 1 as position,
 count(*) over (partition by pool) as size from pool),
ranges as (select pool, ctx, min(position) as lo, count(*) as len from placed group by pool, ctx),
sizes as (select pool, max(size) as size from placed group by pool),
asked as (
 select 'tail' as pool, ctx, source_row_id as target_id, {_list(P.ratios)} as tv from targets where anomaly_type in ('contextual', 'combination')
 union all select 'mix', ctx, source_row_id, {_list(P.shares)} from targets where anomaly_type = 'correlational'
 union all select {_MONO}, ctx, source_row_id, {_list(P.splits)} from targets where anomaly_type in ('structural', 'combination')),
ranged as (select a.*, coalesce(r.lo, 0) as lo, coalesce(r.len, 0) as len, s.size from asked a join sizes s using (pool)
 left join ranges r on r.pool = a.pool and r.ctx = a.ctx),
tries as (select *, {draw(42, "donor", "pool", "target_id", "attempt")} as pick from ranged, (select unnest(range(0, 64)) as attempt) t),
spots as (select *, case when size - len > 0 then case when pick % (size - len) < lo then pick % (size - len) else pick % (size - len) + len end
 else pick % size end as position from tries),
met as (select s.pool, s.target_id, s.attempt, p.vals, [
  (d.a is null and d.b is null) or coalesce(abs(d.a - d.b) <= cast(1e-8 as double) + cast(1e-5 as double) * abs(d.b), false)
  for d in list_transform(list_zip(p.vals, s.tv), lambda z: {{'a': z[1], 'b': z[2]}})] as same
 from spots s join placed p on p.pool = s.pool and p.position = s.position),
donors as (select pool, target_id, arg_min(vals, attempt) as vals from met where not list_bool_and(same) group by pool, target_id),
open_mix as (select t.source_row_id, o.nth, o.pos,
  {_list(P.shares)}[o.pos + 1] as cur, {" + ".join(P.shares)} as whole
 from targets t join ctx_order o on o.ctx = t.ctx where t.anomaly_type in ('energy_mix', 'combination')),
chosen as (select source_row_id, coalesce(min(nth) filter (where not {close("cur", "cast(100 as double)")} or not {close("whole - cur", "cast(0 as double)")}), 1) as nth
 from open_mix group by source_row_id),
sources as (select c.source_row_id, o.pos from chosen c join open_mix o using (source_row_id, nth)),
patched as (select t.source_row_id, t.anomaly_type, s.pos as source, r.vals as ratios, m.vals as mix, b.vals as splits
 from targets t left join sources s using (source_row_id)
 left join donors r on r.target_id = t.source_row_id and r.pool = 'tail'
 left join donors m on m.target_id = t.source_row_id and m.pool = 'mix'
 left join donors b on b.target_id = t.source_row_id and b.pool in ('mono', 'multi')),
labelled_values as (select c.source_row_id, {", ".join(KEPT)}, {", ".join(P.counts)}, {P.mono_flag},
 coalesce(p.anomaly_type, 'none') as anomaly_type, p.anomaly_type is not null as is_anomaly,
 case when p.anomaly_type in ('contextual', 'energy_mix', 'combination') then 'high' when p.anomaly_type is null then 'none' else 'medium' end as anomaly_severity,
 {", ".join(f"case when p.ratios is not null then p.ratios[{i + 1}] else c.{c} end as {c}" for i, c in enumerate(P.ratios))},
 {", ".join(f"case when p.source is not null then case when p.source = {i} then cast(100 as double) else cast(0 as double) end when p.mix is not null then greatest(p.mix[{i + 1}], 0) * (cast(100 as double) / list_sum(list_transform(p.mix, lambda v: greatest(v, 0)))) else c.{c} end as {c}" for i, c in enumerate(P.shares))},
 {", ".join(f"case when p.splits is not null then greatest(p.splits[{i + 1}], 0) * (cast(100 as double) / list_sum(list_transform(p.splits, lambda v: greatest(v, 0)))) else c.{c} end as {c}" for i, c in enumerate(P.splits))}
 from clean c left join patched p using (source_row_id)),
labelled as (select *, {flag(P.shares)} as {P.shares_valid}, {flag(P.splits)} as {P.splits_valid}, {ADJUSTED} - {BRUT} as {P.delta},
 {total(P.shares)} as {P.shares_sum}, {total(P.splits)} as {P.splits_sum} from labelled_values)"""
