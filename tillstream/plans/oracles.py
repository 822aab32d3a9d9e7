"""The catalog's queries as DuckDB SQL over the same tables, for result checks.

These are written from the rules, not from the Spark plans: parsers are
checked against the columns the text was built from, windows by joining every
line to every tick it counts in.
"""

from __future__ import annotations

from tillstream.plans.catalog import COUNTRIES, FIXED_CENTERS, SCORING_CENTERS, WINDOW_MODELS
from tillstream.schema import (
    CANCELLATIONS_TOPIC,
    FEATURE_COLUMNS,
    LINE_COLUMNS,
    MALFORMED_TOPIC,
    WINDOW_FEATURE_COLUMNS,
)

LINES = """
lines as (
  select cast(l_orderkey as varchar) as InvoiceNo,
         concat('P', cast(l_partkey as varchar)) as StockCode,
         p_name as Description,
         cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as int)
           as Quantity,
         concat(strftime(o_orderdate, '%d/%m/%Y'), ' ', cast(l_orderkey % 24 as varchar), ':',
                lpad(cast((l_orderkey * 7) % 60 as varchar), 2, '0')) as InvoiceDate,
         round(l_extendedprice / l_quantity / 100, 2) as UnitPrice,
         cast(o_custkey as varchar) as CustomerID,
         n_name as Country,
         (l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 40 as slot
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join part on l_partkey = p_partkey)
"""

# The damaged lines, field by field as they are written; NULL is "not there".
FIELDS = (
    LINES
    + ''',
fields as (
  select slot,
         case when slot = 14 then '' else InvoiceNo end as InvoiceNo,
         case when slot = 15 then '' else StockCode end as StockCode,
         case when slot = 9 then Description
              when slot = 17 then concat('"', Description, ', ""X"""')
              else concat('"', Description, ', x"') end as Description,
         case when slot = 9 then null when slot = 2 then 'x' when slot = 3 then '2.5'
              when slot = 7 then ' 5 ' when slot = 8 then '0' when slot = 16 then '1'
              else cast(Quantity as varchar) end as Quantity,
         case when slot = 9 then null when slot = 11 then ''
              when slot = 12 then concat(substr(InvoiceDate, 1, 6), substr(InvoiceDate, 9))
              when slot = 13 then 'short' else InvoiceDate end as InvoiceDate,
         case when slot = 9 then null when slot = 4 then '-1' when slot = 5 then 'NaN'
              when slot = 6 then '0' else cast(UnitPrice as varchar) end as UnitPrice,
         case when slot = 9 then null when slot = 0 then '' else CustomerID end as CustomerID,
         case when slot = 9 then null when slot = 1 then '' else Country end as Country,
         Description as plain
  from lines)
'''
)

PARSED = (
    FIELDS
    + """,
parsed as (
  select InvoiceNo as "key",
         nullif(InvoiceNo, '') as InvoiceNo,
         nullif(StockCode, '') as StockCode,
         case when slot = 9 then plain when slot = 17 then concat(plain, ', "X"')
              else concat(plain, ', x') end as Description,
         case when slot in (2, 3, 9) then null else cast(trim(Quantity) as int) end as Quantity,
         nullif(InvoiceDate, '') as InvoiceDate,
         case when slot = 5 then null else cast(UnitPrice as double) end as UnitPrice,
         nullif(CustomerID, '') as CustomerID,
         nullif(Country, '') as Country,
         slot in (9, 10) as is_corrupt,
         slot in (0, 1, 2, 3, 4, 5, 9, 10, 11, 14) as is_wrong,
         slot = 5 as price_is_nan
  from fields)
"""
)


# Lines with thousands of quotes or columns, by how they are built.
HOSTILE = (
    LINES
    + """,
built as (
  select *, case when slot in (0, 1, 2, 3)
                 then repeat('"', case slot when 0 then 4001 when 1 then 4000
                                            when 2 then 40001 else 40000 end) end as quotes
  from lines)
"""
)


def _hostile_field(place: int, name: str) -> str:
    """Odd runs of quotes leave three fields, even ones two, wide lines a letter each."""
    odd = {0: "InvoiceNo", 1: "concat(quotes, 'x,y\"')", 2: "Country"}.get(place, "null")
    even = {0: "concat(InvoiceNo, ',', quotes, 'x,y\"')", 1: "Country"}.get(place, "null")
    wide = "InvoiceNo" if place == 0 else "'n'"
    value = f"""case when slot in (0, 2) then {odd} when slot in (1, 3) then {even}
                     when slot = 4 then {wide} else cast({name} as varchar) end"""
    return f"case when length({value}) > 100 then md5({value}) else {value} end as {name}"


def _hour(date: str, default: str) -> str:
    number = f"try_cast(trim(split_part(substr({date}, 11), ':', 1)) as double)"
    return f"coalesce({number}, {default})"


AMOUNTS = (
    FIELDS
    + """,
amounts as (
  select Quantity, UnitPrice, CustomerID, Country,
         cast(Quantity as int) * cast(UnitPrice as double) as amount
  from fields
  where slot not in (2, 3, 5, 7, 9))
"""
)


def _totals(source: str, amount: str) -> str:
    return f"""
select CustomerID, Country,
       sum(case when {amount} > 0 then {amount} else 0 end) as sales,
       sum(case when {amount} < 0 then -({amount}) else 0 end) as cancellations
from {source} group by CustomerID, Country
"""


def _round_totals(source: str) -> str:
    return f"""
select CustomerID, Country, round(sales, 2) as sales,
       round(cancellations, 2) as cancellations from {source}
"""


TOTALS = LINES + f", totals as ({_totals('lines', 'Quantity * UnitPrice')})"
SELECTED = TOTALS + (
    f", chosen as (select unnest(string_split('{COUNTRIES}', ',')) as item),"
    " selected as (select totals.* from totals join chosen on Country = item where item <> '')"
)


def _top(measure: str, alias: str) -> str:
    return f"""
with {SELECTED}
select CustomerID, Country, round({measure}, 2) as {alias}, rank from (
  select *, cast(row_number() over (partition by Country
                 order by {measure} desc, CustomerID) as int) as rank from selected) ranked
where rank <= 5
"""


FEATURES = (
    LINES
    + f""",
features as (
  select InvoiceNo, avg(UnitPrice) as AvgUnitPrice, min(UnitPrice) as MinUnitPrice,
         max(UnitPrice) as MaxUnitPrice, min({_hour('InvoiceDate', '-1.0')}) as Time,
         cast(sum(Quantity) as bigint) as NumberItems
  from lines where Quantity > 1 and UnitPrice > 0 group by InvoiceNo)
"""
)
ROUNDED_FEATURES = """
select InvoiceNo, round(AvgUnitPrice, 8) as AvgUnitPrice, MinUnitPrice, MaxUnitPrice, Time,
       NumberItems from features
"""


def _distances(names, centers) -> list[str]:
    return [
        "(" + " + ".join(f"pow({n} - ({c!r}), 2)" for n, c in zip(names, center)) + ")"
        for center in centers
    ]


def _nearest(names, centers) -> str:
    return f"list_min([{', '.join(_distances(names, centers))}])"


SCORED = (
    FEATURES
    + f""",
scored as (
  select InvoiceNo, {_nearest(FEATURE_COLUMNS, SCORING_CENTERS)} as distance,
         cast(list_position([{', '.join(_distances(FEATURE_COLUMNS, SCORING_CENTERS))}],
              {_nearest(FEATURE_COLUMNS, SCORING_CENTERS)}) - 1 as int) as prediction
  from features),
threshold as (
  select min(distance) as threshold
  from (select distance from scored order by distance desc limit 2000) furthest)
"""
)
JUDGED = """
select InvoiceNo, prediction, round(distance, DIGITS) as distance,
       distance > (select threshold from threshold) as is_anomaly,
       distance >= (select threshold from threshold) as is_ranked
from scored"""
# The one centroid of k = 1 is the mean.
SINGLE = (
    FEATURES
    + f""",
means as (select {', '.join(f'avg({n}) as m_{n}' for n in FEATURE_COLUMNS)} from features),
scored as (
  select InvoiceNo, cast(0 as int) as prediction,
         {' + '.join(f'pow({n} - m_{n}, 2)' for n in FEATURE_COLUMNS)} as distance
  from features cross join means),
threshold as (
  select min(distance) as threshold
  from (select distance from scored order by distance desc limit 2000) furthest)
"""
)
COSTS = FEATURES + ", costs as (" + " union all ".join(
    f"select {k} as k, sum({_nearest(FEATURE_COLUMNS, FIXED_CENTERS[:k])}) as cost from features"
    for k in range(1, len(FIXED_CENTERS) + 1)
) + ")"


def _purchases(dense: bool) -> str:
    start = "timestamp '2024-01-01 00:00:00'"
    micros = (
        f"(epoch_us({start}) + (epoch_us(ts) - epoch_us({start})) // 1000)"
        if dense
        else "epoch_us(ts)"
    )
    return f"""
purchases as (
  select *, us // 1000000 as sec from (
    select event_id, concat('I', cast(user_id as varchar)) as InvoiceNo,
           cast(case when event_type = 'error' then -1 - (event_id % 5)
                     else 1 + (event_id % 12) end as int) as Quantity,
           strftime(ts, '%d/%m/%Y %-H:%M') as InvoiceDate, round(value, 2) as UnitPrice,
           cast(user_id as varchar) as CustomerID, {micros} as us
    from events) e)
"""


def _windows(source: str = "purchases") -> str:
    return f"""
windows as (
  select InvoiceNo as invoiceNo, sec + i as tick, avg(UnitPrice) as avgUnitPrice,
         min(UnitPrice) as minUnitPrice, max(UnitPrice) as maxUnitPrice,
         arg_min({_hour('InvoiceDate', '0.0')}, us) as time,
         cast(sum(Quantity) as double) as numberItems, max(us) as lastUpdated,
         cast(count(*) as int) as lines, arg_min(CustomerID, us) as customerId
  from {source} cross join (select unnest(generate_series(1, 40)) as i) u
  group by InvoiceNo, sec + i)
"""


ROUNDED_WINDOWS = """
select invoiceNo, tick, round(avgUnitPrice, 8) as avgUnitPrice, minUnitPrice, maxUnitPrice,
       time, numberItems, lastUpdated, lines, customerId from windows
"""

CHANGES = """
changes as (
  select tick, cast(sum(d) over (order by tick) as bigint) as n from (
    select tick, sum(d) as d from (
      select sec + 1 as tick, 1 as d from purchases where Quantity < 0 union all
      select sec + 481, -1 from purchases where Quantity < 0) steps
    group by tick) per_tick)
"""
EVERY_SECOND = """
every_second as (
  select t.tick, count(sec) as n
  from (select unnest(generate_series(
          (select min(sec) + 1 from purchases where Quantity < 0),
          (select max(sec) + 481 from purchases where Quantity < 0))) as tick) t
  left join (select sec from purchases where Quantity < 0) c
    on c.sec < t.tick and c.sec >= t.tick - 480
  group by t.tick)
"""
# Every second from the first line's tick to the last that a line reaches.
COUNTED = """
counted as (
  select t.tick, count(sec) as n
  from (select unnest(generate_series((select min(sec) + 1 from purchases),
                                      (select max(sec) + 480 from purchases))) as tick) t
  left join (select sec from purchases where Quantity < 0) c
    on c.sec < t.tick and c.sec >= t.tick - 480
  group by t.tick)
"""


def _alerts(topic: str) -> str:
    model, threshold = WINDOW_MODELS[topic]
    nearest = _nearest(WINDOW_FEATURE_COLUMNS, model.centers)
    distances = ", ".join(_distances(WINDOW_FEATURE_COLUMNS, model.centers))
    position = f"list_position([{distances}], {nearest})"
    return f"""
select '{topic}' as topic, invoiceNo, tick, cast({position} - 1 as int) as prediction,
       {nearest} as distance
from windows where {nearest} > {threshold!r}
"""


ALERTS = " union all ".join(_alerts(topic) for topic in WINDOW_MODELS)
FIRST_TOPIC = next(iter(WINDOW_MODELS))

_PARSED_COLUMNS = "select * from parsed"

ORACLE_SQL: dict[str, str] = {
    "message_keys": f"""
with {LINES} select InvoiceNo as "key", count(*) as lines from lines group by InvoiceNo""",
    "parse_lines_typed": f"with {PARSED} {_PARSED_COLUMNS}",
    "split_csv_fields": f"with {FIELDS} select * exclude (slot, plain) from fields",
    "parse_hostile_lines": f"""
with {LINES} select InvoiceNo as "key", slot < 5 as is_wrong from lines""",
    "split_hostile_lines": f"""
with {HOSTILE} select {', '.join(_hostile_field(i, n) for i, n in enumerate(LINE_COLUMNS))}
from built""",
    "hour_training": f"""
with {PARSED} select "key", InvoiceDate, {_hour('InvoiceDate', '-1.0')} as Hour from parsed""",
    "hour_streaming": f"""
with {PARSED} select "key", InvoiceDate, {_hour('InvoiceDate', '0.0')} as Hour from parsed""",
    "line_amounts": f"""
with {AMOUNTS} select Quantity, UnitPrice, CustomerID, Country,
     round(amount, 2) + 0.0 as total_price from amounts""",
    "split_volume": f"""
with {AMOUNTS} select CustomerID, Country, round(amount, 2) + 0.0 as total_price,
     case when amount > 0 then round(amount, 2) else 0.0 end as sales,
     case when amount < 0 then round(-amount, 2) else 0.0 end as cancellations from amounts""",
    "customer_totals": f"with {TOTALS} {_round_totals('totals')}",
    "customer_totals_from_text": (
        f"with {AMOUNTS}, totals as ({_totals('amounts', 'amount')}) {_round_totals('totals')}"
    ),
    "customer_totals_without_blanks": (
        f"with {AMOUNTS}, totals as ({_totals('amounts', 'amount')}) {_round_totals('totals')}"
        " where CustomerID <> '' and Country <> ''"
    ),
    "selected_country_totals": f"with {SELECTED} {_round_totals('selected')}",
    "top_sales_by_country": _top("sales", "total_sales"),
    "top_cancellations_by_country": _top("cancellations", "total_cancellations"),
    "malformed_lines": f"with {PARSED} {_PARSED_COLUMNS} where is_wrong",
    "valid_lines": f"with {PARSED} {_PARSED_COLUMNS} where not is_wrong",
    "cancelled_lines": f"with {PARSED} {_PARSED_COLUMNS} where Quantity < 0",
    "malformed_feed": f"""
with {PARSED} select '{MALFORMED_TOPIC}' as topic, "key",
     concat('Purchase(', coalesce(InvoiceNo, 'null'), ',',
            coalesce(cast(Quantity as varchar), 'null'), ',', coalesce(InvoiceDate, 'null'), ',',
            case when price_is_nan then 'NaN'
                 else coalesce(cast(UnitPrice as varchar), 'null') end, ',',
            coalesce(CustomerID, 'null'), ',', coalesce(Country, 'null'), ')') as value
from parsed where is_wrong""",
    "load_invoice_csv": f"""
with {LINES} select * exclude (slot), {_hour('InvoiceDate', '-1.0')} as Hour from lines""",
    "training_lines": f"""
with {PARSED} select InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
     CustomerID, Country, {_hour('InvoiceDate', '-1.0')} as Hour
from parsed where InvoiceNo is not null and StockCode is not null and InvoiceDate is not null
     and Country is not null and Quantity > 1 and UnitPrice > 0""",
    "invoice_features": f"with {FEATURES} {ROUNDED_FEATURES}",
    "feature_preview": f"with {FEATURES} {ROUNDED_FEATURES} order by InvoiceNo limit 30",
    "invoice_windows_40s": f"with {_purchases(False)}, {_windows()} {ROUNDED_WINDOWS}",
    "invoice_windows_dense": f"with {_purchases(True)}, {_windows()} {ROUNDED_WINDOWS}",
    "cancellations_trailing_8min": f"""
with {_purchases(False)}, {CHANGES} select tick, n from changes""",
    "cancellations_every_second": f"""
with {_purchases(True)}, {EVERY_SECOND} select tick, n from every_second""",
    "cancellation_feed": f"""
with {_purchases(True)}, {EVERY_SECOND} select '{CANCELLATIONS_TOPIC}' as topic,
     cast(n as varchar) as "key", cast(n as varchar) as value from every_second""",
    "distance_fixed_centers": f"""
with {SCORED} select InvoiceNo, prediction, round(distance, 6) as distance from scored""",
    "fixed_centers_cost": f"with {SCORED} select round(sum(distance), 2) as cost from scored",
    "threshold_top2000": f"with {SCORED} select round(threshold, 6) as threshold from threshold",
    "anomalies_fixed_centers": f"""
with {SCORED} select InvoiceNo, prediction, round(distance, 6) as distance from scored
where distance > (select threshold from threshold)""",
    "reloaded_single_model": f"with {SINGLE} {JUDGED.replace('DIGITS', '2')}",
    "reloaded_centers": f"with {SCORED} {JUDGED.replace('DIGITS', '6')}",
    "single_cluster_baseline": f"""
with {FEATURES}, means as (select {', '.join(f'avg({n}) as m_{n}' for n in FEATURE_COLUMNS)}
     from features)
select {', '.join(f'round(any_value(m_{n}), 6) as {n}' for n in FEATURE_COLUMNS)},
     round(sum({' + '.join(f'pow({n} - m_{n}, 2)' for n in FEATURE_COLUMNS)}), 1) as cost
from features cross join means""",
    "codebook_costs": f"with {COSTS} select k, round(cost, 1) as cost from costs",
    "elbow_choice": f"""
with {COSTS}, ratios as (
     select k, cost / lag(cost) over (order by k) as ratio from costs)
select coalesce(min(k), 1) as k from ratios where ratio > 0.7""",
    "window_anomalies": f"""
with {_purchases(True)}, {_windows()}, alerts as ({ALERTS})
select topic, invoiceNo, tick, prediction, round(distance, 6) as distance from alerts""",
    "first_anomaly_per_invoice": f"""
with {_purchases(True)}, {_windows()}, alerts as ({_alerts(FIRST_TOPIC)})
select invoiceNo, min(tick) as tick, round(arg_min(distance, tick), 6) as distance
from alerts group by invoiceNo""",
    "stream_customer_totals": f"with {TOTALS} {_round_totals('totals')}",
    "stream_top_sales": _top("sales", "total_sales"),
    "stream_top_cancellations": _top("cancellations", "total_cancellations"),
    "stream_invoice_windows": f"""
with {_purchases(True)}, {_windows()} {ROUNDED_WINDOWS}""",
    "stream_cancellations": f"""
with {_purchases(True)}, {COUNTED} select tick, n from counted""",
    "stream_cancellations_every_second": f"""
with {_purchases(True)}, {COUNTED} select tick, n from counted""",
    "stream_first_anomalies": f"""
with {_purchases(True)}, valid as (select * from purchases where event_id % 50 <> 7),
     {_windows('valid')}, alerts as ({ALERTS})
select topic, invoiceNo as "key", count(distinct invoiceNo) as messages
from alerts group by topic, invoiceNo""",
    "stream_detection_feeds": f"""
with {_purchases(True)}, valid as (select * from purchases where event_id % 50 <> 7),
     {_windows('valid')}, {COUNTED}, alerts as ({ALERTS}),
     messages as (
       select '{MALFORMED_TOPIC}' as topic, InvoiceNo as "key" from purchases
       where event_id % 50 = 7
       union all
       select '{CANCELLATIONS_TOPIC}', cast(n as varchar) from counted
       union all
       select topic, invoiceNo from alerts)
select topic, "key", count(*) as messages from messages group by topic, "key" """,
}
