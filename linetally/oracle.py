"""The same results in DuckDB SQL over the driver's test tables, for the correctness check.

The statements are written independently of the Spark code: rounding is integer
arithmetic, running totals are self-joins, reports start from shared views.
"""

from __future__ import annotations

from linetally.sources.fixtures import AS_OF, REASON_CYCLE, TEST_TYPES
from linetally.sources.tables import REASON_ROWS

VIEWS = {
    "m": """select distinct user_id::int as machine_id, (user_id % 25)::int as line_id
            from events""",
    "e": f"""select event_id, user_id::int as machine_id, ts as event_ts,
                    if(event_type = 'error', 'STOP', 'RUN') as state,
                    if(event_type = 'error', ({list(REASON_CYCLE)})[(event_id % 7 + 1)::int], null)
                        as reason_code
             from events""",
    "rc": f"""select * from (values {", ".join(map(str, REASON_ROWS))})
                     as t(reason_code, reason_category, reason_desc)""",
    "r0": """select o_orderkey as k, o_custkey % 25 as ln,
                    if((o_custkey % 25 + o_orderkey % 45) % 7 = 0, 1, 0) + o_orderkey % 45 as off
             from orders""",
    "r": """select k as work_order_id, ln::int as line_id, (k % 200)::int as product_id,
                   timestamp '2024-01-01 06:00:00' + to_days(off::int) + to_hours((k % 11)::int)
                       as planned_start_ts,
                   planned_start_ts + to_hours(6) as planned_end_ts,
                   planned_start_ts + to_minutes((k % 31)::int) as actual_start_ts,
                   planned_end_ts + to_minutes((k % 61)::int) as actual_end_ts,
                   (if((ln + off) % 11 = 0, 0, 800 + (k * 7) % 401))::int as good_qty,
                   (if((ln + off) % 11 = 0, 0, k % 81))::int as scrap_qty
            from r0""",
    "q": f"""select work_order_id * 2 + x.k as qc_id, work_order_id,
                   actual_start_ts + to_minutes(((work_order_id * 37 + x.k * 101) % 301)::int) as sample_ts,
                   ({list(TEST_TYPES)})[((work_order_id + x.k) % 3 + 1)::int] as test_type,
                   (work_order_id * 17 + x.k) % 100 as value,
                   (work_order_id * 13 + x.k * 7) % 100 >= 12 as in_spec
            from r, (values (0), (1)) as x(k)""",
    "s": """select o_orderkey as shipment_id, o_custkey::int as customer_id,
                   (o_orderkey % 200)::int as product_id, o_orderkey as order_id,
                   date '2023-11-15' + (o_orderkey % 90)::int as requested_ship_date,
                   requested_ship_date
                       + if((o_orderkey * 7) % 100 < 22, 1 + o_orderkey % 7, 0)::int as actual_ship_date,
                   (200 + o_orderkey % 801)::int as shipped_qty
            from orders""",
    "iv": """select e.*, m.line_id, event_ts::date as day,
                    lead(event_ts) over (partition by e.machine_id order by event_ts, event_id) as next_ts,
                    coalesce(date_diff('microsecond', event_ts, next_ts), 0) as us
             from e left join m using (machine_id)""",
    "lt": """select line_id, day, coalesce(sum(us) filter (state = 'RUN'), 0)::bigint as run_us,
                    coalesce(sum(us) filter (state = 'STOP'), 0)::bigint as stop_us
             from iv where line_id is not null group by all""",
    "lo": """select line_id, actual_end_ts::date as day, sum(good_qty)::bigint as good_qty,
                    sum(scrap_qty)::bigint as scrap_qty
             from r group by all""",
}


def _rounded(part: str, whole: str, digits: int) -> str:
    """part / whole for part >= 0, halves rounded up, null when whole is 0."""
    scale = 10**digits
    exact = f"(({2 * scale} * ({part})::hugeint + ({whole})) // (2 * ({whole})::hugeint))"
    return f"if(({whole}) = 0, null, {exact}::double / {scale})"


def _minutes(micros: str) -> str:
    return _rounded(micros, "60000000", 2)


VIEWS["kpi"] = f"""
    select line_id, day,
           {_minutes("coalesce(run_us, 0)")} as runtime_min,
           {_minutes("coalesce(stop_us, 0)")} as downtime_min,
           coalesce(lo.good_qty, 0) as good_qty, coalesce(lo.scrap_qty, 0) as scrap_qty,
           lo.good_qty::double / nullif(lo.good_qty + lo.scrap_qty, 0)::double as "yield",
           if(lo.good_qty + lo.scrap_qty > 0, lo.good_qty::double * 3600000000::double
              / nullif(run_us, 0)::double, null) as throughput_per_hour
    from lt full join lo using (line_id, day)"""

CUT_14, CUT_30, CUT_60 = (f"(date '{AS_OF}' - {days})" for days in (14, 30, 60))


def _with_views(body: str) -> str:
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in VIEWS.items()) + "\n" + body


def _tally(where: str, keys: str, source: str) -> str:
    return f"""select {keys}, count(*) as samples, count_if(not in_spec)::bigint as fails,
               {_rounded("count_if(not in_spec)", "count(*)", 4)} as fail_rate
               from {source} where {where} group by all"""


def _ranked(order: str) -> str:
    return f"""select day, line_id, throughput_per_hour, runtime_min, downtime_min, good_qty, scrap_qty, "yield"
               from (select *, row_number() over (order by throughput_per_hour {order}, day, line_id) as place
                     from kpi where throughput_per_hour is not null and day >= {CUT_30})
               where place <= 15"""


def _duplicates(source: str, table: str, **key: str) -> str:
    shown = " || ',' || ".join(f"""'"{name}":' || {column}::varchar""" for name, column in key.items())
    return f"""select '{table}' as table_name, '{{' || {shown} || '}}' as key, count(*) as n
               from {source} group by all having count(*) > 1"""


def _null_counts(source: str, table: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{table}' as table_name, '{shown}' as column_name, count_if({column} is null)::bigint as n "
        f"from {source}"
        for shown, column in columns.items()
    )


def _orphans(child: str, name: str, column: str, parent: str, key: str, shown: str | None = None) -> str:
    return f"""select '{name}' as child, '{shown or column}' as column_name,
               (select count(*) from {child} c where c.{column} is not null
                and c.{column} not in (select {key} from {parent})) as n"""


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _keys() -> str:
    return " union all ".join(
        [
            _duplicates("region", "dim_plants", plant_id="r_regionkey"),
            _duplicates("nation", "dim_lines", line_id="n_nationkey"),
            _duplicates("m", "dim_machines", machine_id="machine_id"),
            _duplicates("part", "dim_products", product_id="p_partkey"),
            _duplicates("customer", "dim_customers", customer_id="c_custkey"),
            _duplicates("rc", "dim_reason_codes", reason_code="reason_code"),
            _duplicates("r", "fct_production_runs", work_order_id="work_order_id"),
            _duplicates("e", "fct_machine_events", event_id="event_id"),
            _duplicates("q", "fct_qc_results", qc_id="qc_id"),
            _duplicates("s", "fct_shipments", shipment_id="shipment_id"),
            _duplicates("lineitem", "lineitem", l_orderkey="l_orderkey", l_linenumber="l_linenumber"),
        ]
    )


def _references() -> str:
    return " union all ".join(
        [
            _orphans("nation", "dim_lines", "n_regionkey", "region", "r_regionkey", "plant_id"),
            _orphans("m", "dim_machines", "line_id", "nation", "n_nationkey"),
            _orphans("r", "fct_production_runs", "line_id", "nation", "n_nationkey"),
            _orphans("r", "fct_production_runs", "product_id", "part", "p_partkey"),
            _orphans("e", "fct_machine_events", "machine_id", "m", "machine_id"),
            _orphans("e", "fct_machine_events", "reason_code", "rc", "reason_code"),
            _orphans("linked", "fct_machine_events", "work_order_id", "r", "work_order_id"),
            _orphans("q", "fct_qc_results", "work_order_id", "r", "work_order_id"),
            _orphans("s", "fct_shipments", "customer_id", "customer", "c_custkey"),
            _orphans("s", "fct_shipments", "product_id", "part", "p_partkey"),
            _orphans("linked", "linked events", "work_order_id", "(from r where work_order_id % 5 <> 0)", "work_order_id"),
            _orphans("orders", "orders", "o_custkey", "m", "machine_id"),
        ]
    )


def _required() -> str:
    reasons = _same("reason_code", "reason_category", "reason_desc")
    runs = _same(
        "work_order_id",
        "line_id",
        "product_id",
        "planned_start_ts",
        "planned_end_ts",
        "actual_start_ts",
        "actual_end_ts",
        "good_qty",
        "scrap_qty",
    )
    return " union all ".join(
        [
            _null_counts("region", "dim_plants", {"plant_id": "r_regionkey", "plant_name": "r_name"}),
            _null_counts(
                "nation",
                "dim_lines",
                {"line_id": "n_nationkey", "plant_id": "n_regionkey", "line_name": "n_name"},
            ),
            _null_counts(
                "m", "dim_machines", _same("machine_id", "line_id") | {"machine_name": "machine_id"}
            ),
            _null_counts(
                "part",
                "dim_products",
                {"product_id": "p_partkey", "product_family": "p_type", "product_name": "p_name"},
            ),
            _null_counts(
                "customer", "dim_customers", {"customer_id": "c_custkey", "customer_name": "c_name"}
            ),
            _null_counts("rc", "dim_reason_codes", reasons),
            _null_counts("r", "fct_production_runs", runs | {"uom": "'unit'"}),
            _null_counts(
                "e", "fct_machine_events", _same("event_id", "machine_id", "event_ts", "state")
            ),
            _null_counts(
                "q",
                "fct_qc_results",
                _same("qc_id", "work_order_id", "sample_ts", "test_type", "value", "in_spec"),
            ),
            _null_counts(
                "s",
                "fct_shipments",
                _same(
                    "shipment_id",
                    "customer_id",
                    "product_id",
                    "order_id",
                    "requested_ship_date",
                    "actual_ship_date",
                    "shipped_qty",
                ),
            ),
        ]
    )


def _family(keys: str, extra: str) -> str:
    return f"""select {keys}, p.p_type as product_family, {extra}
               sum(good_qty)::bigint as good_qty, sum(scrap_qty)::bigint as scrap_qty
               from r, part p where p.p_partkey = r.product_id and actual_end_ts >= {CUT_30} group by all"""


STATE_INTERVALS = """select event_id, machine_id, line_id, day, state, reason_code, event_ts, next_ts,
                          us as duration_us from iv where line_id is not null"""

MACHINE_TIME = """select machine_id, day, reason_code,
                             sum(if(state = 'RUN', us, 0))::bigint as run_us,
                             sum(if(state = 'STOP', us, 0))::bigint as stop_us
                             from iv group by all"""

EVENT_COLUMNS = "event_id, machine_id, event_ts, state, reason_code"

# Events with faults in two batches, judged row by row.
LOADED = """
        , f as (select event_id, case event_id % 50 when 2 then machine_id + 1000000 when 3 then null else machine_id end
                           as machine_id,
                       if(event_id % 50 = 6, null, event_ts) as event_ts, if(event_id % 50 = 1, 'IDLE', state) as state,
                       if(event_id % 50 in (1, 4), 'NONE', reason_code) as reason_code, event_id % 3 = 0 as first from e),
        g as (select * from f
              union all select * replace (false as first) from f where event_id % 50 = 7
              union all select * replace ('STOP' as state, 'PLAN' as reason_code, false as first) from f
                        where event_id % 50 = 5),
        w as (select *, list_filter([
                         if(machine_id is null, 'null: machine_id', ''), if(event_ts is null, 'null: event_ts', ''),
                         if(state not in ('RUN', 'STOP'), 'domain: state', ''),
                         if(machine_id not in (select machine_id from m), 'reference: machine_id', ''),
                         if(reason_code not in (select reason_code from rc), 'reference: reason_code', '')],
                         lambda x: x <> '') as own from g),
        k as (select event_id as known from w where first and len(own) = 0),
        v as (select w.*, if(known is not null, list_append(own, 'key'), own) as found
              from w left join k on event_id = known and not first),
        judged as (select *, array_to_string(if(len(found) = 0 and nth > 1, ['key'], found), '; ') as reasons
                   from (select *, row_number() over (partition by event_id, len(found) = 0 order by machine_id nulls first,
                                                      event_ts nulls first, state nulls first, reason_code nulls first) as nth
                         from v))"""

LINKED = """
        , n as (select line_id, actual_start_ts::date as day, work_order_id,
                       row_number() over (partition by line_id, day order by work_order_id) - 1 as place,
                       count(*) over (partition by line_id, day) as of_n
                from r)
        , c as (select distinct line_id, day, of_n from n)
        select iv.event_id, iv.machine_id, iv.event_ts, iv.state, iv.reason_code, n.work_order_id
        from iv left join c on c.line_id = iv.line_id and c.day = iv.day
             left join n on n.line_id = iv.line_id and n.day = iv.day and n.place = iv.event_id % c.of_n"""

STATEMENTS = {
    "machine_events": "select * from e",
    "production_runs": "select *, 'unit' as uom from r",
    "qc_results": "select * replace (value::double as value) from q",
    "shipments": "select * from s",
    **dict.fromkeys(
        ("state_intervals", "state_intervals_hourly_pieces", "state_intervals_by_range"), STATE_INTERVALS
    ),
    "insert_machine_events": "select * from e",
    "insert_events_by_key": "select * from e",
    "look_up_events": "select * from e where event_id in (0, 1, 512, 4097, 1000000000000)",
    "numbered_events": "select *, row_number() over (order by event_ts, event_id) as seq from e",
    "load_accepted_events": f"{LOADED} select {EVENT_COLUMNS} from judged where reasons = ''",
    "load_rejected_events": f"{LOADED} select {EVENT_COLUMNS}, reasons from judged where reasons <> ''",
    **dict.fromkeys(("machine_time_daily", "machine_time_hourly_pieces", "refresh_machine_time"), MACHINE_TIME),
    "line_time_daily": "select * from lt",
    "line_output_daily": "select * from lo",
    "line_day_kpi": "select * from kpi",
    "write_line_day_kpi": "select * from kpi",
    "overwrite_line_day_kpi": "select * from kpi",
    "refresh_line_day_kpi": "select * from kpi",
    "kpi_snapshot": f"select * from kpi where day >= {CUT_14}",
    "best_throughput_days": _ranked("desc"),
    "worst_throughput_days": _ranked("asc"),
    "downtime_pareto": f"""
        , c as (select ifnull(reason_category, 'UNKNOWN') as reason_category,
                       sum(if(state = 'STOP', us, 0)) as us
                from iv left join rc using (reason_code) where day >= {CUT_30} group by all)
        select c.reason_category, {_minutes("c.us")} as downtime_min,
               {_rounded("c.us", "sum(o.us)", 4)} as share,
               {_rounded("sum(if(o.us >= c.us, o.us, 0))", "sum(o.us)", 4)} as cumulative_share
        from c, c as o group by c.reason_category, c.us""",
    "downtime_by_line_reason": f"""
        , c as (select line_id, ifnull(reason_category, 'UNKNOWN') as reason_category,
                       sum(if(state = 'STOP', us, 0)) as us
                from iv left join rc using (reason_code)
                where day >= {CUT_30} and line_id is not null group by all)
        select line_id, reason_category, {_minutes("us")} as downtime_min from c""",
    "output_by_family_day": f"""
        , f as ({_family("actual_end_ts::date as day", "")})
        select *, {_rounded("good_qty", "good_qty + scrap_qty", 4)} as "yield" from f""",
    "line_product_mix": _family("line_id", "count(*) as runs,"),
    "schedule_adherence": f"""
        select line_id, actual_end_ts::date as day, count(*) as runs,
               {_rounded("sum(date_diff('microsecond', planned_start_ts, actual_start_ts))",
                         "count(*) * 60000000", 2)} as avg_start_delay_min,
               {_rounded("sum(date_diff('microsecond', planned_end_ts, actual_end_ts))",
                         "count(*) * 60000000", 2)} as avg_end_delay_min,
               {_rounded("count_if(actual_end_ts <= planned_end_ts)", "count(*)", 4)} as on_time_share
        from r where actual_end_ts >= {CUT_30} group by all""",
    "qc_fail_by_test": _tally(f"sample_ts >= {CUT_30}", "test_type", "q"),
    **dict.fromkeys(
        ("qc_fail_by_line_day", "qc_fail_by_line_day_stored_by_order"),
        _tally(f"sample_ts >= {CUT_30}", "line_id, sample_ts::date as day", "q join r using (work_order_id)"),
    ),
    "qc_vs_yield": f"""
        , d as ({_tally(f"sample_ts >= {CUT_30}", "line_id, sample_ts::date as day",
                        "q join r using (work_order_id)")})
        select d.*, "yield" from d join kpi using (line_id, day)""",
    "on_time_overall": f"""
        select {_rounded("count_if(actual_ship_date <= requested_ship_date)", "count(*)", 4)} as on_time_rate,
               count(*) as shipments
        from s where requested_ship_date >= {CUT_60}""",
    "on_time_by_customer": f"""
        select c.c_name as customer_name, count(*) as shipments,
               {_rounded("count_if(actual_ship_date <= requested_ship_date)", "count(*)", 4)} as on_time_rate,
               {_rounded("sum(if(actual_ship_date > requested_ship_date, "
                         "actual_ship_date - requested_ship_date, 0))", "count(*)", 2)} as avg_days_late
        from s, customer c where c.c_custkey = s.customer_id and requested_ship_date >= {CUT_60}
        group by c.c_name""",
    "pk_violations": _keys(),
    "fk_orphans": f", linked as (with z as (select 1) {LINKED}) {_references()}",
    "not_null_violations": f""", linked as (with z as (select 1) {LINKED}) {_required()}
        union all {_null_counts("linked", "linked events", _same("reason_code", "work_order_id"))}""",
    "state_domain_violations": """
        select 'fct_machine_events' as table_name, 'state' as column_name, state as value, count(*) as n
        from e where state not in ('RUN', 'STOP') group by all
        union all
        select 'events', 'event_type', event_type, count(*)
        from events where event_type not in ('RUN', 'STOP') group by all""",
    "uom_default": """select o_orderkey as work_order_id,
                      if(o_orderstatus = 'P', 'unit', 'kg') as uom from orders""",
    "machine_day_grid": """select machine_id, d::date as day
        from m, generate_series(timestamp '2024-01-01', timestamp '2024-01-30', interval 1 day) as g(d)""",
    "assign_work_order": f"{LINKED}",
    "log_vs_output_check": """
        , x as (select line_id, day, run_us, good_qty + scrap_qty as made
                from lt full join lo using (line_id, day))
        select case when made is null then 'NO_OUTPUT' when run_us is null then 'NO_EVENTS'
                    when run_us = 0 and made > 0 then 'RUNTIME_ZERO_WITH_OUTPUT' else 'OK' end as status,
               count(*) as line_days
        from x group by all""",
}


def statements() -> dict[str, str]:
    return {name: _with_views(body.strip()) for name, body in STATEMENTS.items()}
