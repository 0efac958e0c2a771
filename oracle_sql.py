"""DuckDB SQL for every named query (the correctness oracle).

Written independently of the Spark code: the adapter views are plain SQL
over the driver tables and each query is a SQL statement over them.
"""

from __future__ import annotations

INGEST_MS = 1706745600000
SCAN_DATE = "2024-01-15"

# (table, event name, [(field, kind)], has_et, needs_report_type);
# kind 'dec' fields print with their scale, the rest through to_json.
SPECS = [
    ("page_vidw", "page_vidw", [("refer_page_id", "s"), ("page_id", "s")], True, True),
    ("element_click", "element_click",
     [("click_type", "s"), ("click_position", "s"), ("click_name", "s"), ("click_area", "s")], True, True),
    ("pay", "pay", [("pay_type", "s"), ("pay_amount", "dec"), ("package_type", "s"), ("package_id", "s"),
                    ("package_name", "s"), ("is_ai", "n")], True, True),
    ("pay_result", "pay_result",
     [("pay_result", "s"), ("pay_type", "s"), ("pay_amount", "dec"), ("package_type", "s"),
      ("package_id", "s"), ("package_name", "s"), ("is_ai", "n"), ("source", "s"), ("device", "s"),
      ("device_type", "s"), ("sale_channel", "s"), ("sd_card", "s"), ("device_first_time", "n"),
      ("cloud_expire_time", "n")], True, True),
    ("user_info", "__profile_set", [("reg_time", "n"), ("ys_dev_cnt", "n"), ("user_add_day", "n")], False, False),
]
SPEC = {s[0]: s for s in SPECS}
SINGLE_TABLES = ("pay", "pay_result")

VIEWS = {
    "page_vidw": """select event_id, dt, user_unique_id, et,
  case when k % 5 = 0 then null else concat('page_', cast(k % 10 as varchar)) end as refer_page_id,
  concat('page_', cast(k as varchar)) as page_id
from base where event_type = 'view'""",
    "element_click": """select event_id, dt, user_unique_id, et,
  case when k % 2 = 0 then 'tap' else 'long_press' end as click_type,
  concat('pos_', cast(k % 4 as varchar)) as click_position,
  concat('btn_', cast(k as varchar)) as click_name,
  case when k % 7 = 0 then null else concat('area_', cast(k % 6 as varchar)) end as click_area
from base where event_type = 'click'""",
    "pay": """select event_id, dt, user_unique_id, et,
  case when k % 2 = 0 then 'card' else 'wallet' end as pay_type,
  amount as pay_amount,
  case when k % 3 = 0 then null else 'cloud' end as package_type,
  concat('pkg_', cast(k as varchar)) as package_id,
  concat('Package ', cast(k as varchar)) as package_name,
  k % 2 as is_ai
from base where event_type = 'purchase'""",
    "pay_result": """select event_id, dt, user_unique_id, et,
  case when k % 4 = 0 then 'fail' else 'ok' end as pay_result,
  case when k % 2 = 0 then 'card' else 'wallet' end as pay_type,
  amount as pay_amount,
  'cloud' as package_type,
  concat('pkg_', cast(k as varchar)) as package_id,
  concat('Package ', cast(k as varchar)) as package_name,
  k % 2 as is_ai,
  case when k % 3 = 0 then null else 'app' end as source,
  concat('dev_', cast(event_id as varchar)) as device,
  concat('type_', cast(k % 3 as varchar)) as device_type,
  case when k % 5 = 0 then null else 'store' end as sale_channel,
  case when k % 2 = 0 then 'yes' else null end as sd_card,
  case when k % 6 = 0 then null else 1600000000000 + event_id end as device_first_time,
  case when k % 6 = 1 then null else 1800000000000 + event_id end as cloud_expire_time
from base where event_type = 'error'""",
    "user_info": """select event_id, dt, user_unique_id,
  1600000000000 + event_id as reg_time,
  case when k % 5 = 0 then null else k % 5 end as ys_dev_cnt,
  k as user_add_day
from base where event_type = 'signup'""",
}


def base_sql(gran: str = "day") -> str:
    day = "cast(cast(ts as date) as varchar)"
    dt = day if gran == "day" else f"substr({day}, 1, 7)"
    return f"""select event_id, event_type, {dt} as dt,
  case when event_id % 13 = 0 then concat('u', cast(user_id as varchar))
       else concat('user_', lpad(cast(user_id as varchar), 8, '0')) end as user_unique_id,
  case when event_id % 11 = 0 then null else epoch_us(ts) // 1000 end as et,
  cast(json_extract_string(props, '$.k') as int) as k,
  cast(value as decimal(10,2)) as amount
from events"""


def _jv(field: str, kind: str) -> str:
    return f"cast({field} as varchar)" if kind == "dec" else f"to_json({field})::varchar"


def params_sql(table: str) -> str:
    _, _, fields, _, rt = SPEC[table]
    parts = (["'\"report_type\":\"poc_v1\"'"] if rt else []) + \
        [f"'\"{f}\":' || {_jv(f, k)}" for f, k in fields]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def ltm_sql(table: str) -> str:
    return f"coalesce(et, {INGEST_MS})" if SPEC[table][3] else f"{INGEST_MS}"


def payload_select(table: str) -> str:
    ev = SPEC[table][1]
    return f"""select '{table}' as table_name, dt, event_id, user_unique_id, '{ev}' as event,
  {params_sql(table)} as params, cast({ltm_sql(table)} as bigint) as local_time_ms
from {table}"""


def body_sql(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"""'{{"user":{{"user_unique_id":' || coalesce(to_json({a}user_unique_id)::varchar, 'null') || """
            f"""',"device_id":null,"web_id":null}},"header":{{}},"events":[{{"event":' || to_json({a}event)::varchar || """
            f"""',"params":' || to_json({a}params)::varchar || ',"local_time_ms":' || cast({a}local_time_ms as varchar) || '}}]}}'""")


def with_views(sql: str, gran: str = "day") -> str:
    ctes = [f"base as ({base_sql(gran)})"] + [f"{t} as ({v})" for t, v in VIEWS.items()]
    pl = " union all ".join(f"({payload_select(t)})" for t in SPEC)
    ctes.append(f"payloads0 as ({pl})")
    ctes.append(f"payloads as (select *, {body_sql()} as body from payloads0)")
    return "with " + ",\n".join(ctes) + "\n" + sql


def q_payload_json(t: str) -> str:
    return with_views(f"select event_id, dt, body from payloads where table_name = '{t}'")


def q_payload(t: str) -> str:
    return with_views(f"select event_id, dt, user_unique_id, event, params, local_time_ms "
                      f"from payloads where table_name = '{t}'")


def stats_sql() -> str:
    names = [s[0] for s in SPECS]
    tagged = " union all ".join(f"select '{t}' as table_name, dt from {t}" for t in names)
    cols = ", ".join(f"count(*) filter (where table_name = '{t}') as c{i}" for i, t in enumerate(names))
    rows = " union all ".join(f"select dt, '{t}' as table_name, c{i} as n, {i} as ordinal from wide"
                              for i, t in enumerate(names))
    return f"""tagged as ({tagged}),
wide as (select dt, {cols} from tagged group by dt),
per as ({rows}),
stats as (
  select dt, table_name, cast(n as bigint) as n, cast(ordinal as int) as ordinal from per
  union all
  select dt, 'TOTAL', cast(sum(n) as bigint), {len(names)} from per group by dt
)"""


def with_stats(sql: str) -> str:
    return with_views(", " + stats_sql() + "\n" + sql)


MASK_SQL = ("case when {c} is null or length({c}) <= 8 then '***' "
            "else substr({c}, 1, 4) || '***' || right({c}, 4) end")


def mask_sql(c: str) -> str:
    return MASK_SQL.format(c=c)


def record_json_sql(table: str, uid: str = "user_unique_id") -> str:
    """Source record as JSON with nulls written (registry field order)."""
    _, _, fields, has_et, _ = SPEC[table]
    parts = [f"'\"user_unique_id\":' || coalesce(to_json({uid})::varchar, 'null')"]
    if has_et:
        parts.append("'\"et\":' || coalesce(cast(et as varchar), 'null')")
    for f, k in fields:
        parts.append(f"'\"{f}\":' || coalesce({_jv(f, k)}, 'null')")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def run_sql(gran: str = "day", size: int = 20, reject: bool = False,
            single: tuple[str, ...] = SINGLE_TABLES, page: int = 1000) -> str:
    """CTEs of a whole report run: assigned rows, outbox, attempts,
    classified attempts, outcomes, record outcomes."""
    err = "case when not starts_with(user_unique_id, 'user_') then 'Transform failed' end" if reject \
        else "cast(null as varchar)"
    per_page = -(-page // size)
    modes = "case when table_name in (" + ", ".join(f"'{t}'" for t in single) + ") then 'SINGLE' else 'BATCH' end"
    recs = " union all ".join(f"select '{t}' as table_name, event_id, {record_json_sql(t)} as record_json from {t}"
                              for t in SPEC)
    masked_recs = " union all ".join(
        f"select '{t}' as table_name, event_id, {record_json_sql(t, 'm_uid')} as record_json_masked "
        f"from (select *, {mask_sql('coalesce(user_unique_id, \'unknown\')')} as m_uid from {t})"
        for t in SPEC)
    return f""", records as ({recs}),
masked_records as ({masked_recs}),
a00 as (select p.*, {err} as error, {modes} as mode from payloads p),
a0 as (select *, case when mode = 'BATCH'
         then row_number() over (partition by table_name, dt order by event_id) - 1 end as ord
       from a00),
a1 as (select *, ord // {page} as page_no from a0),
a2 as (select *, row_number() over (partition by table_name, dt, page_no, error is null order by ord) - 1 as in_page
       from a1),
assigned as (select *,
   case when error is not null then null when mode = 'SINGLE' then event_id
        else page_no * {per_page} + in_page // {size} end as request_no,
   case when mode = 'SINGLE' then '/v2/event/json' else '/v2/event/list' end as endpoint
  from a2),
outbox as (
  select 'run' as run_id, table_name, dt, request_no, endpoint, 1 as n_records, body
  from assigned where mode = 'SINGLE' and request_no is not null
  union all
  select 'run', table_name, dt, request_no, endpoint, cast(count(*) as int),
         '[' || string_agg(body, ',' order by ord) || ']'
  from assigned where mode = 'BATCH' and request_no is not null
  group by table_name, dt, request_no, endpoint),
att0 as (select table_name, dt, request_no, n_records,
           unnest(case when request_no % 23 = 0 then [1, 2] else [1, 2, 3] end) as attempt from outbox),
att1 as (select *, case (request_no * 7 + attempt * 3) % 5 when 0 then 503 when 1 then 0 when 2 then 429
                    when 3 then 500 else 200 end as http_status from att0),
attempts as (select 'run' as run_id, table_name, dt, request_no, attempt, http_status,
   case when http_status = 200 then
          case when request_no % 17 = 0 then 'not json'
               when request_no % 7 = 0 then '{{"e":0,"message":"partial","sc":' || cast(n_records - 1 as varchar) || ',"ec":1}}'
               else '{{"e":0,"message":"success","sc":' || cast(n_records as varchar) || ',"ec":0}}' end
        when http_status = 0 then null
        else '{{"e":' || cast(http_status as varchar) || ',"message":"server busy"}}' end as body,
   case when http_status = 0 then 'Read timed out' end as transport_error,
   1706745600 + request_no * 3 + attempt as started_s,
   10 + (request_no * 13 + attempt) % 90 as duration_ms
  from att1),
classified as (select *, http_status = 200 as ok,
   case when http_status = 200 then null
        when http_status = 0 then 'Connection error: ' || coalesce(transport_error, '')
        else 'HTTP ' || cast(http_status as varchar) || ': ' || coalesce(body, '') end as error
  from attempts),
oc0 as (select *, min(attempt) filter (where ok) over r as ok_at, max(attempt) over r as max_at
        from classified where attempt <= 3
        window r as (partition by table_name, dt, request_no)),
outcome as (select o.table_name, o.dt, o.request_no, o.ok_attempt is not null as success, o.ok_attempt,
     o.attempts_used, o.duration_ms,
     case when table_name in ({", ".join(f"'{t}'" for t in single)}) then 'SINGLE' else 'BATCH' end as mode,
     case when o.ok_attempt is not null then null
          when o.attempts_used < 3 then 'Retry interrupted'
          when table_name in ({", ".join(f"'{t}'" for t in single)}) then 'Max retries exceeded'
          else 'Batch report failed: ' || coalesce(o.last_error, '') end as reason
  from (select table_name, dt, request_no, min(ok_at) as ok_attempt,
          cast(coalesce(min(ok_at), max(max_at)) as int) as attempts_used,
          arg_max(error, attempt) filter (where not ok) as last_error,
          cast(sum(duration_ms) filter (where attempt <= coalesce(ok_at, max_at)) as bigint) as duration_ms
        from oc0 group by table_name, dt, request_no) o),
record_outcomes as (
  select a.table_name, a.dt, a.event_id, a.request_no, a.user_unique_id, a.error,
    case when a.error is not null then 'failed' when o.success is null then 'unsent'
         when o.success then 'success' else 'failed' end as status,
    case when a.error is not null then a.error else o.reason end as reason,
    o.attempts_used
  from assigned a left join outcome o
    on a.table_name = o.table_name and a.dt = o.dt and a.request_no = o.request_no),
dead_letters as (
  select 'run' as run_id, r.table_name, r.dt,
    {mask_sql("coalesce(r.user_unique_id, 'unknown')")} as user_masked, r.reason,
    m.record_json_masked as record_json, x.record_json as record_json_raw
  from record_outcomes r
  join records x on x.table_name = r.table_name and x.event_id = r.event_id
  join masked_records m on m.table_name = r.table_name and m.event_id = r.event_id
  where r.status = 'failed'),
counts as (select table_name, dt, count(*) as n from payloads group by table_name, dt),
table_results as (
  select c.table_name, c.dt, cast(c.n as bigint) as total,
    cast(count(*) filter (where r.status = 'success') as bigint) as success,
    cast(count(*) filter (where r.status = 'failed') as bigint) as fail,
    cast(count(*) filter (where r.status = 'unsent') as bigint) as unsent
  from counts c join record_outcomes r on r.table_name = c.table_name and r.dt = c.dt
  group by c.table_name, c.dt, c.n),
frs as (select table_name, dt, request_no, attempt, ok,
          row_number() over (partition by table_name, dt order by started_s, request_no, attempt) - 1 as seq
        from classified),
frw as (select *, count(*) over w as n_calls, sum(case when ok then 0 else 1 end) over w as n_fail
        from frs window w as (partition by table_name, dt order by seq rows between 9 preceding and current row)),
frb as (select *, case when n_calls >= 5 then round(n_fail / n_calls, 6) end as failure_rate,
          coalesce(n_calls >= 5 and n_fail / n_calls >= 0.5, false) as breaker_open from frw),
breaker as (select table_name, dt, request_no, attempt, seq, n_calls, failure_rate, breaker_open,
   breaker_open and not coalesce(lag(breaker_open) over (partition by table_name, dt order by seq), false) as opened
  from frb)
"""


def with_run(sql: str, **kw) -> str:
    gran = kw.pop("gran", "day")
    return with_views(run_sql(gran, **kw) + sql, gran)


TRACKED = """tracked as (select
  case substr(o_orderpriority, 1, 1) when '1' then 'page_vidw' when '2' then 'element_click'
    when '3' then 'pay' when '4' then 'pay_result' when '5' then 'user_info' end as table_name,
  o_orderkey as id,
  concat('user_', lpad(cast(o_custkey as varchar), 8, '0')) as user_unique_id,
  cast(case when o_orderkey % 10 < 5 then 0 when o_orderkey % 10 = 5 then 1
       when o_orderkey % 10 < 8 then 2 else 3 end as int) as report_status,
  cast(case when o_orderkey % 10 >= 8 then o_orderkey % 5 else 0 end as int) as retry_count,
  o_orderdate as updated_at
from orders),
g1_page as (select table_name, id from (
  select *, row_number() over (partition by table_name order by id) as rn
  from tracked where id > 0 and report_status = 0)),
g1_log as (
  select table_name, id, 1 as seq, 1 as status, cast(null as varchar) as error_msg, false as bump,
         timestamp '2024-02-01 00:00:00' as updated_at from g1_page
  union all
  select table_name, id, 2, 2, null, false, timestamp '2024-02-01 00:01:00' from g1_page where id % 7 <> 0
  union all
  select table_name, id, 2, 3, substr('HTTP 503: ' || repeat('server busy ', 50), 1, 500), true,
         timestamp '2024-02-01 00:01:00' from g1_page where id % 7 = 0),
g1_latest as (select table_name, id, max(seq) as seq, arg_max(status, seq) as status,
    arg_max(error_msg, seq) filter (where error_msg is not null) as error_msg,
    arg_max(updated_at, seq) as updated_at, min(updated_at) as first_at,
    cast(count(*) filter (where bump) as int) as bumps
  from g1_log group by table_name, id),
g1_applied as (select t.table_name, t.id, cast(coalesce(l.status, t.report_status) as int) as report_status,
    cast(t.retry_count + coalesce(l.bumps, 0) as int) as retry_count, l.error_msg
  from tracked t left join g1_latest l on t.table_name = l.table_name and t.id = l.id),
g1_progress as (select table_name, 'report' as task_type, max(id) as last_processed_id,
    count(*) as processed_count, cast(count(*) filter (where status = 2) as bigint) as success_count,
    cast(count(*) filter (where status = 3) as bigint) as fail_count,
    strftime(min(first_at), '%Y-%m-%d %H:%M:%S') as start_time,
    strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') as end_time
  from g1_latest where status in (2, 3) group by table_name),
pending_batches as (select table_name, ord // 20 as batch_no, id from (
  select table_name, id, row_number() over (partition by table_name order by id) - 1 as ord
  from tracked where report_status = 0 and id is not null))
"""

# rounds of the resend job: a SINGLE row is a request of its own (numbered by id),
# the others go by 20 in the order of their ids; every request is tried three times
# (every 23rd twice) with answers that move on by two per round
RESEND = """, sent as (
  select 1 as round, table_name, id, retry_count as before, retry_count, 0 as ok, null::varchar as reason
  from tracked where report_status = 3 and retry_count < 6
  union all
  select round + 1, table_name, id, before, retry_count + 1 - ok, ok, reason from (
    select *, case when first_ok is not null then 1 else 0 end as ok,
      case when first_ok is not null then null when request_no % 23 = 0 then 'Retry interrupted'
           when mode = 'SINGLE' then 'Max retries exceeded'
           else 'Batch report failed: ' || case (request_no * 7 + 9 + 2 * round) % 5
             when 0 then 'HTTP 503: {"e":503,"message":"server busy"}' when 1 then 'Connection error: Read timed out'
             when 2 then 'HTTP 429: {"e":429,"message":"server busy"}' else 'HTTP 500: {"e":500,"message":"server busy"}' end end as reason
    from (select r.*, list_filter(case when request_no % 23 = 0 then [1, 2] else [1, 2, 3] end,
                                  lambda a: (request_no * 7 + a * 3 + 2 * round) % 5 = 4)[1] as first_ok
          from (select round, table_name, id, before, retry_count,
                  case when table_name in ('pay', 'pay_result') then 'SINGLE' else 'BATCH' end as mode,
                  case when table_name in ('pay', 'pay_result') then id else (n // 1000) * 50 + (n % 1000) // 20 end as request_no
                from (select *, row_number() over (partition by table_name order by id) - 1 as n
                      from sent where ok = 0 and retry_count < 6)) r))),
after_round as (select round - 1 as round, table_name, id, before, retry_count, ok, reason from sent where round > 1)
"""


def with_resend(sql: str) -> str:
    return "with recursive " + TRACKED + RESEND + sql


TABLE_NAMES = [s[0] for s in SPECS]


def with_tracked(sql: str) -> str:
    return "with " + TRACKED + sql


SECRET_DOC = """'{"doc_id":' || cast(doc_id as varchar) || ',"password"' || sp || '"pw' || cast(doc_id as varchar)
  || '","lang":"' || lang || '","appKey":"ak-' || cast(n_chars as varchar) || '","token"' || sp || '"tok'
  || cast(doc_id as varchar) || '","secret":"' || lang || '-s","apiKey":"k' || cast(doc_id as varchar)
  || '","api_key":"x","n_chars":' || cast(n_chars as varchar) || ',"secretCount":3}'"""
SECRET_RE = '("(?:password|appKey|token|secret|apiKey|api_key)"\\s*:\\s*")[^"]*'

OUTCOME_COLS = "table_name, dt, request_no, mode, success, ok_attempt, attempts_used, duration_ms, reason"


def build() -> dict[str, str]:
    out: dict[str, str] = {}
    for t in SPEC:
        out[f"payload_json_{t}"] = q_payload_json(t)
        out[f"payload_{t}"] = q_payload(t)
    out["registry_projection"] = with_views(
        "select event_id, dt, user_unique_id, et, pay_result, pay_type, pay_amount, package_type, "
        "package_id, package_name, is_ai, source, device, device_type, sale_channel, sd_card, "
        "device_first_time, cloud_expire_time from pay_result")
    out["scan_partition"] = with_views(
        "select event_id, dt, user_unique_id, et, click_type, click_position, click_name, click_area "
        f"from element_click where dt = '{SCAN_DATE}'")
    out["event_time_fallback"] = with_views(
        f"select table_name, event_id, local_time_ms, local_time_ms = {INGEST_MS} as used_ingest_time "
        "from payloads")
    out["partition_count"] = with_views(
        "select table_name, dt, count(*) as n from payloads group by table_name, dt")
    out["stats_by_date"] = with_stats("select dt, table_name, n, ordinal from stats")
    out["stats_report_lines"] = with_stats(
        "select dt, ordinal, '  ' || case when length(table_name) >= 20 then table_name else rpad(table_name, 20, ' ') end || ' : ' || cast(n as varchar) as line from stats")
    out["batch_assignment"] = with_run(
        "select table_name, dt, event_id, ord, request_no as batch_no from assigned where mode = 'BATCH'")
    out["page_batch_assignment"] = with_run(
        "select table_name, dt, event_id, ord, page_no, request_no as batch_no from assigned "
        "where mode = 'BATCH'", gran="month", size=30)
    out["batch_after_errors"] = with_run(
        "select table_name, dt, event_id, ord, page_no, mode, request_no, error from assigned",
        gran="month", size=30, reject=True)
    plan = """select table_name, dt, mode, cast(n as bigint) as n_records,
      cast(case when mode = 'SINGLE' then n else (n // {page}) * {per} + ceil((n % {page}) / {size}) end as bigint) as best_calls,
      cast(3 * case when mode = 'SINGLE' then n else (n // {page}) * {per} + ceil((n % {page}) / {size}) end as bigint) as worst_calls
    from (select table_name, dt, count(*) as n,
            case when table_name in ({single}) then 'SINGLE' else 'BATCH' end as mode
          from payloads group by table_name, dt)"""
    out["request_plan"] = with_views(plan.format(page=1000, per=34, size=30, single="'pay', 'pay_result'"),
                                     "month")
    out["mode_resolution"] = with_views(
        "select table_name, dt, mode, best_calls from (" +
        plan.format(page=1000, per=50, size=20, single="'pay_result', 'element_click'") + ")")
    out["page_slice"] = with_views("""select table_name, dt, event_id, ord from (
        select table_name, dt, event_id,
          row_number() over (partition by table_name, dt order by event_id) - 1 as ord from payloads)
      where ord // 1000 = 1""", "month")
    ob = "select run_id, table_name, dt, request_no, endpoint, n_records, body from outbox"
    out["outbox_single"] = with_run(ob + " where endpoint = '/v2/event/json'")
    out["outbox_batch"] = with_run(ob + " where endpoint = '/v2/event/list'")
    out["outbox_all"] = with_run(ob)
    out["transform_errors"] = with_run(
        "select table_name, dt, event_id, error from assigned where error is not null", reject=True)
    out["attempt_classify"] = with_run(
        "select table_name, dt, request_no, attempt, http_status, ok, error from classified")
    out["response_parse"] = with_run("""select table_name, dt, request_no, attempt,
        case when json_valid(body) then cast(json_extract(body, '$.e') as int) end as e,
        case when json_valid(body) then json_extract_string(body, '$.message') end as message,
        case when json_valid(body) then cast(json_extract(body, '$.sc') as int) end as sc,
        case when json_valid(body) then cast(json_extract(body, '$.ec') as int) end as ec
      from classified""")
    out["single_outcome"] = with_run(f"select {OUTCOME_COLS} from outcome where mode = 'SINGLE'")
    out["batch_outcome"] = with_run(f"select {OUTCOME_COLS} from outcome where mode = 'BATCH'")
    out["interrupted_requests"] = with_run(f"select {OUTCOME_COLS} from outcome where reason = 'Retry interrupted'")
    out["recovered_requests"] = with_run(f"select {OUTCOME_COLS} from outcome where ok_attempt > 1")
    out["record_outcomes"] = with_run(
        "select table_name, dt, event_id, request_no, status, reason, attempts_used from record_outcomes",
        reject=True)
    out["stream_record_outcomes"] = out["record_outcomes"]  # the same rows, after the last watermark
    out["failure_rate_window"] = with_run("select * from breaker")
    out["partial_errors"] = with_run("""select table_name, dt, count(*) as n_responses,
        cast(sum(cast(json_extract(body, '$.sc') as int)) as bigint) as sum_sc,
        cast(sum(cast(json_extract(body, '$.ec') as int)) as bigint) as sum_ec
      from classified where http_status = 200 and json_valid(body)
        and cast(json_extract(body, '$.ec') as int) > 0
      group by table_name, dt""")
    out["dead_letters"] = with_run(
        "select run_id, table_name, dt, user_masked, reason, record_json from dead_letters", reject=True)
    out["dead_letter_counts"] = with_run(
        "select dt, table_name, reason, count(*) as n from dead_letters group by dt, table_name, reason",
        reject=True)
    out["table_result"] = with_run("select * from table_results", reject=True)
    out["run_summary"] = with_run("""select dt, table_name,
        case when dt is null then 'all' when table_name is null then 'date' else 'table' end as level,
        cast(sum(total) as bigint) as total, cast(sum(success) as bigint) as success,
        cast(sum(fail) as bigint) as fail,
        'Summary: total=' || cast(sum(total) as varchar) || ', success=' || cast(sum(success) as varchar)
          || ', fail=' || cast(sum(fail) as varchar) as line
      from table_results group by rollup (dt, table_name)""", reject=True)
    out["isolated_summary"] = with_run("""select dt, table_name,
        case when dt is null then 'all' when table_name is null then 'date' else 'table' end as level,
        cast(sum(total) as bigint) as total, cast(sum(success) as bigint) as success,
        cast(sum(fail) + case when dt is null then 1 else 0 end as bigint) as fail, null::varchar as error
      from table_results where table_name <> 'user_info' group by rollup (dt, table_name)
      union all select null, 'user_info', 'error', 0, 0, 1, '[DAMAGED] page cannot be read'""")
    out["metrics_summary"] = with_run("""select metric, value from (
        select 'records_processed' as metric, cast(count(*) as double) as value from record_outcomes
        union all select 'records_success', cast(count(*) filter (where status = 'success') as double) from record_outcomes
        union all select 'records_failed', cast(count(*) filter (where status = 'failed') as double) from record_outcomes
        union all select 'requests_sent', cast(count(*) as double) from outcome
        union all select 'requests_success', cast(count(*) filter (where success) as double) from outcome
        union all select 'requests_failed', cast(count(*) filter (where not success) as double) from outcome
        union all select 'avg_request_ms', round(avg(duration_ms), 3) from outcome
        union all select 'breaker_opens', cast(sum(cast(opened as int)) as double) from breaker
      ) where value is not null""")
    out["processing_rate"] = with_run("""select
        strftime(make_timestamp(cast((started_s // 60) * 60 * 1000000 as bigint)), '%Y-%m-%d %H:%M:%S') as window_start,
        table_name, count(*) as attempts, cast(count(*) filter (where ok) as bigint) as ok,
        cast(count(*) filter (where not ok) as bigint) as failed
      from classified group by 1, table_name""")
    out["attempt_success_rate"] = with_run("""select table_name, count(*) as attempts,
        cast(count(*) filter (where ok) as bigint) as ok,
        cast(count(*) filter (where http_status = 0) as bigint) as io_errors,
        cast(count(*) filter (where http_status <> 0 and not ok) as bigint) as http_errors,
        round(avg(case when ok then 1.0 else 0.0 end), 6) as success_rate
      from classified group by table_name""")
    out["retry_histogram"] = with_run(
        "select table_name, attempts_used, success, count(*) as n from outcome group by table_name, attempts_used, success")
    # status-tracked path
    out["status_decode"] = with_tracked("""select table_name, id, report_status,
        case report_status when 0 then 'Pending' when 1 then 'Processing' when 2 then 'Success'
          when 3 then 'Failed' end as description, report_status between 0 and 3 as is_valid from tracked""")
    out["status_invalid"] = with_tracked("""select table_name, id, cast(id % 7 - 1 as int) as code
        from tracked where not (id % 7 - 1 between 0 and 3)""")
    out["pending_keyset_scan"] = with_tracked("""select table_name, id, user_unique_id from (
        select *, row_number() over (partition by table_name order by id) as rn
        from tracked where id > 1000 and report_status = 0) where rn <= 500""")
    out["retryable_scan"] = with_tracked("""select table_name, id, retry_count from (
        select *, row_number() over (partition by table_name order by id) as rn
        from tracked where report_status = 3 and retry_count < 4) where rn <= 500""")
    out["pending_count"] = with_tracked(
        "select table_name, count(*) as n from tracked where report_status = 0 group by table_name")
    names_values = ", ".join(f"({i}, '{t}')" for i, t in enumerate(TABLE_NAMES))
    out["pending_counts_all"] = with_tracked(f"""reg(ordinal, table_name) as (values {names_values}),
      per as (select cast(r.ordinal as int) as ordinal, r.table_name,
          cast(count(t.id) as bigint) as n
        from reg r left join tracked t on t.table_name = r.table_name and t.report_status = 0
        group by r.ordinal, r.table_name)
      select * from per union all select {len(TABLE_NAMES)}, 'TOTAL', cast(sum(n) as bigint) from per""".replace(
        "reg(ordinal", ", reg(ordinal", 1))
    out["pending_nonzero"] = with_tracked("""select table_name, n from (select table_name, count(*) as n
        from tracked where report_status = 0 group by table_name) where n > 0""")
    out["status_histogram"] = with_tracked(
        "select table_name, report_status, count(*) as n from tracked group by table_name, report_status")
    out["batch_record_ids"] = with_tracked("""select table_name, batch_no,
        string_agg(cast(id as varchar), ',' order by id) as record_ids from pending_batches
        group by table_name, batch_no""")
    out["max_record_id"] = with_tracked("""select table_name, batch_no,
        cast(greatest(coalesce(max(id), 0), 0) as bigint) as max_record_id from pending_batches
        group by table_name, batch_no""")
    out["status_apply"] = with_tracked("select table_name, id, report_status, retry_count from g1_applied")
    out["status_with_error"] = with_tracked("""select table_name, id, report_status, retry_count, error_msg,
        cast(length(error_msg) as int) as error_len from g1_applied where error_msg is not null""")
    out["latest_status"] = with_tracked(
        "select table_name, id, cast(seq as bigint) as seq, cast(status as int) as status, error_msg from g1_latest")
    out["retry_exhausted"] = with_tracked(
        "select table_name, id, retry_count from g1_applied where report_status = 3 and retry_count >= 3")
    out["task_progress"] = with_tracked("""select p.*, 'report-' || p.table_name as task_id,
        cast(case when success_count = 0 then 3 else 2 end as int) as status, e.error_msg
      from g1_progress p left join (select table_name, arg_max(error_msg, id) as error_msg from g1_latest
        where status = 3 group by table_name) e using (table_name)""")
    out["incremental_pending"] = with_tracked("""select t.table_name, t.id from tracked t
        left join (select table_name, max(id) as last_processed_id from g1_latest
          where status in (2, 3) and id <= (select max(id) // 2 from tracked) group by table_name) p on p.table_name = t.table_name
        where t.report_status = 0 and t.id > coalesce(p.last_processed_id, 0)""")
    out["stale_processing"] = with_tracked("""select table_name, id from tracked
        where report_status = 1 and updated_at < timestamp '2000-01-01 00:00:00' - interval 1 hour""")
    # masking, JSON, coercion
    out["mask_user_id"] = with_views(f"select event_id, user_unique_id, {mask_sql('user_unique_id')} as masked from base")
    out["mask_json"] = f"""select doc_id, regexp_replace(doc, '{SECRET_RE}', '\\1***', 'g') as masked
      from (select doc_id, {SECRET_DOC} as doc
            from (select *, case when doc_id % 2 = 0 then ' : ' else ':' end as sp from documents))"""
    out["mask_json_documents"] = f"""select doc_id, masked, masked <> body as redacted from (
        select doc_id, body, regexp_replace(body, '{SECRET_RE}', '\\1***', 'g') as masked from (
          select doc_id, '{{"doc_id":' || cast(doc_id as varchar)
            || case when lang is null then '' else ',"lang":' || to_json(lang)::varchar end
            || case when tok = '' then '' else ',"token":' || to_json(tok)::varchar end
            || case when text is null then '' else ',"text":' || to_json(text)::varchar end || '}}' as body
          from (select *, regexp_extract(text, 'token = "([0-9a-f]+)"', 1) as tok from documents)))"""
    out["mask_url"] = """select page_id, url,
        case when contains(url, '?') and (contains(url, 'key=') or contains(url, 'token=')
               or contains(url, 'password=') or contains(url, 'secret='))
             then split_part(url, '?', 1) || '?***' else url end as masked_url
      from (select page_id, case when page_id % 3 = 0 and contains(url, '?') then url || '&token=abc'
                                 else url end as url from pages)"""
    out["record_json"] = with_views(f"select event_id, {record_json_sql('pay_result')} as record_json from pay_result")
    out["json_typed_parse"] = with_views(
        "select event_id, user_unique_id, et, pay_amount, cast(is_ai as int) as is_ai, package_type from pay")
    out["json_map_parse"] = with_views("""select event_id,
        unnest(['user_unique_id', 'et', 'click_type', 'click_position', 'click_name', 'click_area']) as key,
        unnest([user_unique_id, cast(et as varchar), click_type, click_position, click_name, click_area]) as value
      from element_click""")
    out["map_to_json"] = with_views("""select event_id,
        '{"click_type":' || coalesce(to_json(click_type)::varchar, 'null') || ',"click_area":'
          || coalesce(to_json(click_area)::varchar, 'null') || '}' as json from element_click""")
    out["long_coercion"] = with_views("""select event_id, text,
        case when regexp_full_match(text, '[+-]?[0-9]+') then try_cast(text as bigint) end as as_long,
        cast(trunc(amount) as bigint) as amount_long
      from (select event_id, amount, case event_id % 7 when 0 then cast(k as varchar)
          when 1 then '+' || cast(k as varchar) when 2 then ' ' || cast(k as varchar) || ' '
          when 3 then cast(k as varchar) || '.9' when 4 then 'x' || cast(k as varchar)
          when 5 then '99999999999999999999' else '-' || cast(k as varchar) end as text from base)""")
    out["mode_parse"] = """select event_id, mode_text,
        case when upper(trim(mode_text)) = 'SINGLE' then 'SINGLE' else 'BATCH' end as mode
      from (select event_id, case event_id % 6 when 0 then 'single' when 1 then ' SINGLE ' when 2 then 'BATCH'
              when 3 then '' when 4 then null else 'x' end as mode_text from events)"""
    mapping = " ".join(f"when '{e}' then '{t}'" for t, e in
                       [("page_vidw", "view"), ("element_click", "click"), ("pay", "purchase"),
                        ("pay_result", "error"), ("user_info", "signup")])
    out["table_validation"] = f"""select table_name,
        coalesce(table_name in ({", ".join(f"'{t}'" for t in TABLE_NAMES)}), false) as is_valid
      from (select event_type as table_name from events
            union select case event_type {mapping} end from events)"""
    # logs, backfill, duplicates
    failed_msg = ("'FAILED: table=' || table_name || ', dt=' || dt || ', user=' || user_masked || "
                  "', reason=' || reason || ', record=' || record_json_raw")
    out["failed_log_parse"] = with_run(
        "select table_name, dt, user_masked, reason, record_json_raw as record_json from dead_letters", reject=True)
    out["summary_log_parse"] = with_run("""select cast(sum(total) as bigint) as total,
        cast(sum(success) as bigint) as success, cast(sum(fail) as bigint) as fail
      from table_results group by dt""", reject=True)
    out["log_error_filter"] = with_run(
        f"select 'ERROR' as level, 'FAILED_RECORDS' as logger, {failed_msg} || replace(replace('|java.io.IOException: not delivered|~at relay.Sender.send(Sender.java:42)||~... 3 more', '|', chr(10)), '~', chr(9)) as msg from dead_letters", reject=True)
    out["backfill_range"] = with_run("""select dt, cast(sum(total) as bigint) as total,
        cast(sum(success) as bigint) as success, cast(sum(fail) as bigint) as fail
      from table_results where dt between '2024-01-05' and '2024-01-20' group by dt""", reject=True)
    out["failed_dates"] = with_run("""select dt, cast(sum(fail) as bigint) as fail
      from table_results group by dt having sum(fail) > 0""")
    raw = " union all ".join(f"select event_id, {'et' if SPEC[t][3] else 'null::bigint as et'} from {t}" for t in TABLE_NAMES)
    replayed = f""", raw as ({raw}), keyed as (
      select event_id, table_name, dt, sha256(concat_ws(chr(1), coalesce(table_name, chr(2)), coalesce(dt, chr(2)),
        coalesce(user_unique_id, chr(2)), coalesce(cast(et as varchar), chr(2)), coalesce(params, chr(2)))) as delivery_key
      from payloads join raw using (event_id)),
    replayed as (select * from keyed union all select * from keyed where event_id % 10 = 3)"""
    out["duplicate_report"] = with_views(replayed + """
      select table_name, dt, delivery_key, count(*) as n from replayed group by table_name, dt, delivery_key having count(*) > 1""")
    out["not_delivered"] = with_views(replayed + """
      select * from replayed where delivery_key not in (select delivery_key from keyed where event_id % 10 in (3, 5, 8))""")
    # one file, so one epoch: run "run-0"
    out["stream_outbox"] = with_run("select run_id || '-0' as run_id, table_name, dt, request_no, endpoint, n_records, body from outbox")
    out["outbox_keyless"] = with_run("""select table_name, dt, endpoint, cast(null as bigint) as request_no, body, count(*) as n
      from assigned group by table_name, dt, endpoint, body
      union all
      select table_name, dt, endpoint, row_number() over (partition by table_name, dt, endpoint order by request_no) - 1,
        null, cast(n_records as bigint) from outbox""")
    singles = "table_name in ('pay', 'pay_result')"
    out["stream_epochs"] = with_views(f"""select run_id, table_name, dt,
        case when {singles} then '/v2/event/json' else '/v2/event/list' end as endpoint,
        case when {singles} then n else (n + 19) // 20 end as n_requests, n as n_records
      from (select 'run-' || cast(event_id % 3 as varchar) as run_id, table_name, dt, count(*) as n from payloads group by all)""")
    out["stream_dedupe"] = with_views(replayed + " select distinct table_name, dt, delivery_key from replayed")
    out["stream_latest_status"] = out["latest_status"]
    out["stream_stale_processing"] = with_tracked("""select table_name, id from tracked
        where report_status = 1 and updated_at < timestamp '2030-01-01 00:00:00' - interval 1 hour""")
    out["partition_count_footers"] = with_views(
        "select table_name, dt, count(*) as n from payloads group by table_name, dt", "month")
    out["metrics_observed"] = with_run("""select 'records_processed' as metric, cast(count(*) as double) as value from record_outcomes
        union all select 'records_success', cast(count(*) filter (where status = 'success') as double) from record_outcomes
        union all select 'records_failed', cast(count(*) filter (where status = 'failed') as double) from record_outcomes
        union all select 'requests_sent', cast(count(*) as double) from outcome
        union all select 'requests_success', cast(count(*) filter (where success) as double) from outcome
        union all select 'requests_failed', cast(count(*) filter (where not success) as double) from outcome
        union all select 'avg_request_ms', round(avg(duration_ms), 3) from outcome
        union all select 'avg_batch_ms', round(avg(duration_ms) filter (where mode = 'BATCH'), 3) from outcome
        union all select 'breaker_opens', cast(count(*) filter (where opened) as double) from breaker
        union all select 'avg_query_ms', 1.0""")
    out["json_variant_parse"] = with_views("""select table_name, event_id, event, local_time_ms, 'BIGINT' as time_kind, user_unique_id,
        cast(null as varchar) as device_id, cast(json_extract_string(params, '$.pay_amount') as decimal(10,2)) as pay_amount,
        cast(json_extract_string(params, '$.is_ai') as int) as is_ai, json_extract_string(params, '$.page_id') as page_id
      from payloads""")
    out["unknown_table_rows"] = with_views(f"""select 'promo_view' as table_name, dt, {mask_sql('user_unique_id')} as user_masked,
        'Unknown table name: promo_view' as reason from base where event_type = 'view'""")
    out["custom_table_payloads"] = """select l_orderkey * 10 + l_linenumber as event_id, strftime(l_shipdate, '%Y-%m') as dt,
        'part_' || cast(l_partkey as varchar) as user_unique_id,
        '{"report_type":"poc_v1","order_id":' || cast(l_orderkey as varchar) || ',"line_no":' || cast(l_linenumber as varchar)
          || ',"quantity":' || cast(cast(l_quantity as decimal(12,2)) as varchar)
          || ',"price":' || cast(cast(l_extendedprice as decimal(12,2)) as varchar)
          || ',"returned":' || case when l_returnflag = 'R' then 'true' else 'false' end
          || case when l_linestatus = 'O' then '' else ',"ship_mode":"' || l_linestatus || '"' end || '}' as params
      from lineitem"""
    names = ", ".join(f"({i}, '{n}')" for i, n in enumerate(TABLE_NAMES))
    out["stats_empty_date"] = with_views(f""", c as (
        select d.dt, t.table_name, t.i, count(p.table_name) as n
        from (select distinct dt from payloads union select '1999-12-31' union select '2024-01-15') d
        cross join (values {names}) t(i, table_name)
        left join payloads p on p.dt = d.dt and p.table_name = t.table_name group by d.dt, t.table_name, t.i),
      r as (select dt, table_name, n from c union all select dt, 'TOTAL', cast(sum(n) as bigint) from c group by dt)
      select dt, table_name, n, '  ' || rpad(table_name, 20, ' ') || ' : ' || cast(n as varchar) as line from r""")
    out["status_after_relock"] = with_tracked("""select table_name, id,
        cast(case when error_msg is not null then 1 else report_status end as int) as report_status, retry_count, error_msg
      from g1_applied""")
    out["status_compacted"] = with_tracked("select table_name, id, report_status, retry_count, error_msg from g1_applied")
    out["ids_membership"] = with_tracked("""select table_name, id, user_unique_id from tracked
      where report_status = 0 and id % 10 = 3""")
    out["stream_rate_metrics"] = with_run("""select
        strftime(make_timestamp(cast((started_s // 60) * 60 * 1000000 as bigint)), '%Y-%m-%d %H:%M:%S') as window_start,
        table_name, count(*) as attempts, cast(count(*) filter (where ok) as bigint) as ok,
        cast(count(*) filter (where not ok) as bigint) as failed
      from classified group by started_s // 60, table_name""")
    out["resend_failed"] = with_resend("""select table_name, id, cast(max(round) as int) as rounds,
        cast(case when max(ok) = 1 then 2 else 3 end as int) as report_status, cast(max(retry_count) as int) as retry_count,
        max(ok) = 0 and max(retry_count) >= 6 as given_up, arg_max(reason, round) filter (where reason is not null) as error_msg
      from after_round group by table_name, id""")
    out["resend_rounds"] = with_resend("""select cast(round as int) as round, table_name, count(*) as sent,
        cast(sum(ok) as bigint) as success, cast(sum(1 - ok) as bigint) as fail from after_round group by round, table_name""")
    out["pretty_json"] = with_views(f"select event_id, {len(SPEC['pay'][2]) + 4} as n_lines, "
                                    f"{record_json_sql('pay')} as compact from pay")
    return out
