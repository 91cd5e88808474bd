"""SQL twins of the catalog queries for DuckDB, over the same tables.

Written from the definitions, not from the Spark code: joins are plain, dates are cast, positions are global
windows. Sums are cast to BIGINT and averages to DOUBLE so both engines return one type.
"""

from __future__ import annotations

ACCIDENTS = """
accidents as (
  select cast(o_orderkey as varchar) as accident_index,
    case o_orderpriority when '1-URGENT' then 'Fatal' when '2-HIGH' then 'Serious' else 'Slight' end as accident_severity,
    case when o_orderkey % 53 = 0 then '' else cast(cast(o_orderdate as date) as varchar) end as "date",
    case when o_orderkey % 11 = 0 then ''
      else concat(lpad(cast(o_custkey % 24 as varchar), 2, '0'), ':', lpad(cast(o_orderkey % 60 as varchar), 2, '0')) end as "time",
    case when o_orderkey % 97 = 0 then '' else cast(cast(51 + (o_custkey % 25)/100.0 as decimal(5,2)) as varchar) end as latitude,
    cast(cast(-0.30 + (o_orderkey % 30)/100.0 as decimal(5,2)) as varchar) as longitude,
    cast(1 + o_custkey % 4 as varchar) as number_of_casualties,
    cast(1 + o_orderkey % 3 as varchar) as number_of_vehicles,
    case o_orderstatus when 'F' then 'Fine no high winds' when 'O' then 'Raining no high winds' else '' end as weather_conditions,
    case when o_orderkey % 2 = 0 then 'Daylight' else 'Darkness - lights lit' end as light_conditions,
    case o_custkey % 3 when 0 then 'Dry' when 1 then 'Wet or damp' else 'Frost or ice' end as road_surface_conditions,
    case when o_orderkey % 101 = 0 then '' when o_orderkey % 2 = 0 then cast(20 + 10*(o_custkey % 6) as varchar)
      else concat(cast(20 + 10*(o_custkey % 6) as varchar), '.0') end as speed_limit,
    case when o_totalprice < 100000 then 'Single carriageway' when o_totalprice < 200000 then 'Dual carriageway'
      else 'Roundabout' end as road_type,
    n_name as local_authority_district,
    case when c_acctbal < 0 then 'Rural' else 'Urban' end as urban_or_rural_area
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""

VEHICLES = """
vehicles as (
  select cast(l_orderkey as varchar) as accident_index,
    case when l_quantity < 10 then '16 - 20' when l_quantity < 20 then '21 - 25' when l_quantity < 30 then '26 - 35'
      when l_quantity < 40 then '36 - 45' else 'Data missing or out of range' end as age_band_of_driver,
    case l_returnflag when 'A' then 'Male' when 'R' then 'Female' else 'Not known' end as sex_of_driver,
    case when l_linenumber = 7 then '' when l_linenumber = 6 then cast(l_partkey % 20 as varchar)
      else concat(cast(l_partkey % 20 as varchar), '.0') end as age_of_vehicle,
    cast(extract(year from l_shipdate) as varchar) as "year",
    p_type as vehicle_type
  from lineitem join part on l_partkey = p_partkey)"""


def _hash(buckets: int) -> str:
    return f"cast('0x' || substr(md5(accident_index), 1, 8) as bigint) % {buckets}"


def _long(c: str) -> str:
    return f"cast(trunc(try_cast({c} as double)) as bigint)"


DAY = "try_cast(\"date\" as date)"
ISO_DAY = "strftime(event_date, '%Y-%m-%d')"
ISO_STAMP = "strftime({}, '%Y-%m-%dT%H:%M:%S')"

# One row per event with its keys and what it adds, then rollups of those.
GEO_ROWS = f"""
geo_rows as (
  select accident_index, {DAY} as event_date,
    round(try_cast(latitude as decimal(18,6)), 1) as lat_grid, round(try_cast(longitude as decimal(18,6)), 1) as lon_grid,
    accident_severity, {_long('number_of_casualties')} as casualties, {_long('number_of_vehicles')} as vehicle_number
  from accidents
  where {DAY} is not null and try_cast(latitude as double) is not null and try_cast(longitude as double) is not null)"""
GEO_SUMS = """count(*) as accident_count,
    count(*) filter (where accident_severity = 'Fatal') as fatal_count,
    count(*) filter (where accident_severity = 'Serious') as serious_count,
    count(*) filter (where accident_severity = 'Slight') as slight_count,
    cast(coalesce(sum(casualties), 0) as bigint) as total_casualties,
    cast(coalesce(sum(vehicle_number), 0) as bigint) as total_vehicles"""
GEO_KEYS = f"{ISO_DAY} as event_date, cast(lat_grid as double) as lat_grid, cast(lon_grid as double) as lon_grid"

CONDITION_ROWS = f"""
condition_rows as (
  select accident_index, {DAY} as event_date, weather_conditions, light_conditions, road_surface_conditions,
    cast({_long('speed_limit')} as integer) as speed_limit, accident_severity,
    case accident_severity when 'Fatal' then 3 when 'Serious' then 2 else 1 end as score
  from accidents where {DAY} is not null and try_cast(speed_limit as double) is not null)"""
CONDITION_KEYS = "event_date, weather_conditions, light_conditions, road_surface_conditions, speed_limit"
CONDITION_SUMS = """count(*) as accident_count, cast(sum(score) as bigint) as severity_sum,
    count(*) filter (where accident_severity = 'Fatal') as fatal_count"""

HOTSPOT_ROWS = f"""
hotspot_rows as (
  select accident_index, {DAY} as event_date, local_authority_district, road_type, urban_or_rural_area,
    case accident_severity when 'Fatal' then 5 when 'Serious' then 3 else 1 end as weight
  from accidents where {DAY} is not null)"""
HOTSPOT_KEYS = "event_date, local_authority_district, road_type, urban_or_rural_area"
HOTSPOT_SUMS = "cast(sum(weight) as bigint) as weighted_count, count(*) as accident_count"

PROFILE_ROWS = f"""
profile_rows as (
  select accident_index, cast({_long('"year"')} as integer) as "year", age_band_of_driver, sex_of_driver, vehicle_type,
    {_long('age_of_vehicle')} as age
  from vehicles where try_cast("year" as double) is not null)"""
PROFILE_KEYS = '"year", age_band_of_driver, sex_of_driver, vehicle_type'
PROFILE_SUMS = """count(*) as vehicle_count, cast(coalesce(sum(age), 0) as bigint) as age_of_vehicle_sum,
    count(age) as age_of_vehicle_count"""

NEWEST = f"max(timestamp '2024-01-01 00:00:00' + to_hours(cast({_hash(4)} as integer))) as newest"
DEMOGRAPHIC_KEYS = "age_band_of_driver, sex_of_driver, vehicle_type, accident_severity"

CLEAN = """
clean as (
  select accident_index, age_band_of_driver, sex_of_driver, vehicle_type, accident_severity
  from vehicles join accidents using (accident_index)
  where age_band_of_driver not in ('', 'Data missing or out of range', 'Not known', 'Unknown', '-1', 'Other')
    and sex_of_driver not in ('', 'Data missing or out of range', 'Not known', 'Unknown', '-1', 'Other')
    and vehicle_type not in ('', 'Data missing or out of range', 'Not known', 'Unknown', '-1', 'Other')
    and accident_severity <> '')"""
GROUPS = f"groups as (select {DEMOGRAPHIC_KEYS}, count(*) as n from clean group by all)"
SPLIT = f"""
drawn as (
  select *, (count(*) over (partition by accident_severity) * 20 + 50) // 100 as held,
    row_number() over (partition by accident_severity
      order by substr(md5(concat_ws('|', '42', accident_index, age_band_of_driver, sex_of_driver, vehicle_type)), 1, 15)) as place
  from clean),
parts as (
  select {DEMOGRAPHIC_KEYS}, count(*) as n, count(*) filter (where place <= held) as n_test
  from drawn group by all)"""


def _with(*parts: str) -> str:
    return "with " + ", ".join(p.strip() for p in parts)


def _average(total: str, count: str, places: int) -> str:
    scale = 10**places
    return f"cast(({2 * scale} * {total} + {count}) // (2 * nullif({count}, 0)) as double) / {scale}"


GEO = f"{_with(ACCIDENTS, GEO_ROWS)}, geo as (select event_date, lat_grid, lon_grid, {GEO_SUMS}, {NEWEST} from geo_rows group by 1, 2, 3)"
CONDITIONS = f"{_with(ACCIDENTS, CONDITION_ROWS)}, conditions as (select {CONDITION_KEYS}, {CONDITION_SUMS}, {NEWEST} from condition_rows group by {CONDITION_KEYS})"
HOTSPOTS = f"{_with(ACCIDENTS, HOTSPOT_ROWS)}, hotspots as (select {HOTSPOT_KEYS}, {HOTSPOT_SUMS}, {NEWEST} from hotspot_rows group by {HOTSPOT_KEYS})"
PROFILE = f"{_with(VEHICLES, PROFILE_ROWS)}, profile as (select {PROFILE_KEYS}, {PROFILE_SUMS}, {NEWEST} from profile_rows group by {PROFILE_KEYS})"
FRAME = f"{_with(ACCIDENTS, VEHICLES, CLEAN, GROUPS)}"

GEO_MEASURES = "accident_count, fatal_count, serious_count, slight_count, total_casualties, total_vehicles"
CONDITION_OUT = CONDITION_KEYS.replace("event_date", f"{ISO_DAY} as event_date")
HOTSPOT_OUT = HOTSPOT_KEYS.replace("event_date", f"{ISO_DAY} as event_date")
STAMPED = ISO_STAMP.format("newest") + " as inserted_at"
AVG_SEVERITY = _average("severity_sum", "accident_count", 3) + " as avg_severity"
AVG_AGE = _average("age_of_vehicle_sum", "age_of_vehicle_count", 2) + " as avg_age"
ENVELOPE_TIME = "nullif(concat_ws(' ', nullif(\"date\", ''), nullif(\"time\", '')), '')"
ACCIDENT_SEQ = "row_number() over (order by accident_index) - 1"
VEHICLE_SEQ = (
    "row_number() over (order by accident_index, age_band_of_driver, sex_of_driver, age_of_vehicle, \"year\", vehicle_type) - 1"
)

TOTALS = """cast(coalesce(sum(accident_count), 0) as bigint) as total_accidents, cast(coalesce(sum(fatal_count), 0) as bigint) as total_fatal,
  cast(coalesce(sum(serious_count), 0) as bigint) as total_serious, cast(coalesce(sum(slight_count), 0) as bigint) as total_slight,
  cast(coalesce(sum(total_casualties), 0) as bigint) as total_casualties, cast(coalesce(sum(total_vehicles), 0) as bigint) as total_vehicles"""
TOP_DISTRICTS = """select local_authority_district as district, cast(sum(weighted_count) as bigint) as weighted, cast(sum(accident_count) as bigint) as accidents
  from hotspots group by 1 order by weighted desc, district limit 10"""
TOP_WEATHER = """select weather_conditions, cast(sum(accident_count) as bigint) as accidents, cast(sum(fatal_count) as bigint) as fatal
  from conditions group by 1 order by accidents desc, weather_conditions limit {}"""
AGE_BANDS = """select age_band_of_driver as age_band, cast(sum(vehicle_count) as bigint) as vehicles
  from profile where age_band_of_driver <> 'Data missing or out of range' group by 1 order by vehicles desc, age_band"""

GEO_RESULT = f"{GEO} select {GEO_KEYS}, {GEO_MEASURES} from geo"
CONDITION_RESULT = f"{CONDITIONS} select {CONDITION_OUT}, accident_count, severity_sum, fatal_count from conditions"
HOTSPOT_RESULT = f"{HOTSPOTS} select {HOTSPOT_OUT}, weighted_count, accident_count from hotspots"
PROFILE_RESULT = f"{PROFILE} select {PROFILE_KEYS}, vehicle_count, age_of_vehicle_sum, age_of_vehicle_count from profile"
ACCIDENT_EXTRACT = f"{_with(ACCIDENTS)} select accident_index, accident_severity from accidents"
VEHICLE_EXTRACT = f"{_with(VEHICLES)} select accident_index, age_band_of_driver, sex_of_driver, vehicle_type from vehicles"

# Newton steps for the balanced, penalised classifier: each step sums gradient and Hessian over the groups and solves for
# the change by elimination. Slot 0 is the intercept; a coefficient has number class * slots + slot.
NEWTON_STEPS = 12
MODEL = f"""{FRAME.replace("with ", "with recursive ", 1)}, {SPLIT.strip()},
trained as (select *, n - n_test as n_train from parts where n > n_test),
class_rows as (select accident_severity, sum(n_train) as rows from trained group by 1),
known as (select accident_severity, cast(row_number() over (order by accident_severity) - 1 as integer) as label,
  cast(sum(rows) over () as double) / cast(count(*) over () * rows as double) as balance from class_rows),
options as (select f, value, cast(row_number() over (order by f, value) as integer) as slot from (
  select distinct 1 as f, age_band_of_driver as value from trained union all
  select distinct 2, sex_of_driver from trained union all select distinct 3, vehicle_type from trained)),
dims as (select (select count(*) from options) + 1 as slots, (select count(*) from known) as classes),
weighted as (select label, n_train * balance as weight, [0, a.slot, s.slot, t.slot] as active
  from trained join known using (accident_severity) join options a on a.f = 1 and a.value = age_band_of_driver
  join options s on s.f = 2 and s.value = sex_of_driver join options t on t.f = 3 and t.value = vehicle_type),
newton(step, w) as (
  select 0, list_transform(range(slots * classes), lambda x: cast(0 as double)) from dims
  union all
  select step + 1, list_transform(w, lambda x, q: x - solved[q][len(w) + 1]) from (
    select step, w, list_reduce(
      list_transform(range(-1, len(w)), lambda k: {{'k': k, 'a': case when k < 0 then matrix else cast([] as double[][]) end}}),
      lambda acc, e: {{'k': e.k, 'a': list_transform(acc.a, lambda line, i: list_transform(line, lambda x, q:
        case when i - 1 = e.k then x / acc.a[e.k + 1][e.k + 1]
        else x - line[e.k + 1] * acc.a[e.k + 1][q] / acc.a[e.k + 1][e.k + 1] end))}}).a as solved
    from (
      select step, w, list(line order by r) as matrix from (
        select step, w, r, list(value order by q) as line from (
          select step, w, r, q,
            case when q < slots * classes then
              coalesce(sum(weight * p[r // slots + 1] * (cast(r // slots = q // slots as integer) - p[q // slots + 1]))
                filter (where list_contains(active, r % slots) and list_contains(active, q % slots)), 0)
              + cast(r = q and r % slots > 0 as integer) + cast(r % slots = 0 and q % slots = 0 as integer)
            else
              coalesce(sum(weight * (p[r // slots + 1] - cast(label = r // slots as integer))) filter (where list_contains(active, r % slots)), 0)
              + cast(r % slots > 0 as integer) * w[r + 1] end as value
          from (
            select step, w, label, weight, active, slots, classes, list_transform(e, lambda x: x / list_sum(e)) as p from (
              select *, list_transform(z, lambda x: exp(x - list_max(z))) as e from (
                select step, w, label, weight, active, slots, classes,
                  list_transform(range(classes), lambda c: list_sum(list_transform(active, lambda s: w[c * slots + s + 1]))) as z
                from newton, weighted, dims where step < {NEWTON_STEPS}))) scored,
            (select unnest(range(slots * classes)) as r from dims) lines,
            (select unnest(range(slots * classes + 1)) as q from dims) places
          group by step, w, r, q, slots, classes)
        group by step, w, r)
      group by step, w))),
fitted as (select w from newton where step = {NEWTON_STEPS}),
coefficients as (select accident_severity, label, list_slice(w, label * slots + 1, (label + 1) * slots) as w from fitted, dims, known)"""

CASES = """
scores as (select cases.*, accident_severity as class, label,
    c.w[1] + coalesce(c.w[a.slot + 1], 0) + coalesce(c.w[s.slot + 1], 0) + coalesce(c.w[t.slot + 1], 0) as z
  from cases cross join coefficients c left join options a on a.f = 1 and a.value = age_band_of_driver
  left join options s on s.f = 2 and s.value = sex_of_driver left join options t on t.f = 3 and t.value = vehicle_type),
raised as (select *, exp(z - max(z) over (partition by age_band_of_driver, sex_of_driver, vehicle_type)) as e from scores),
chances as (select *, e / sum(e) over (partition by age_band_of_driver, sex_of_driver, vehicle_type) as p,
    row_number() over (partition by age_band_of_driver, sex_of_driver, vehicle_type order by z desc, label) as place from raised),
best as (select age_band_of_driver, sex_of_driver, vehicle_type, class as predicted from chances where place = 1)"""
PREDICTED = f"""{MODEL}, cases as (select distinct age_band_of_driver, sex_of_driver, vehicle_type from parts), {CASES.strip()},
predicted_parts as (select parts.*, predicted from parts join best using (age_band_of_driver, sex_of_driver, vehicle_type))"""
ACCURACY = "cast(sum({0}) filter (where predicted = accident_severity) as double) / cast(sum({0}) as double)"
REPORT = """classes as (select actual as class from ruled union select predicted from ruled),
        sums as (select class,
          coalesce((select sum(n) from ruled where actual = class), 0) as support,
          coalesce((select sum(n) from ruled where predicted = class), 0) as claimed,
          coalesce((select sum(n) from ruled where actual = class and predicted = class), 0) as hits from classes),
        per_class as (select class, cast(support as bigint) as support,
          coalesce(cast(hits as double) / nullif(cast(claimed as double), 0), 0) as precision,
          coalesce(cast(hits as double) / nullif(cast(support as double), 0), 0) as recall,
          coalesce(cast(2 * hits as double) / nullif(cast(claimed + support as double), 0), 0) as f1 from sums),
        report as (select class, support, precision, recall, f1 from per_class
          union all select 'accuracy', cast(sum(support) as bigint), null, null, cast(sum(hits) as double) / cast(sum(support) as double) from sums
          union all select 'macro avg', cast(sum(support) as bigint), avg(precision), avg(recall), avg(f1) from per_class
          union all select 'weighted avg', cast(sum(support) as bigint), sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support) from per_class)
        select class, support, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1 from report"""

ORACLE: dict[str, str] = {
    "prep_filter_sort": f"{_with(VEHICLES)} select * from vehicles where not starts_with(accident_index, '2004') order by accident_index",
    "csv_latin1_subset": f"{_with(ACCIDENTS)} select accident_index, accident_severity, concat(road_type, ' é') as road_type from accidents",
    "messages_by_key": f"{_with(VEHICLES)} select accident_index as key, cast(1 as bigint) as partitions, count(*) as n from vehicles group by 1",
    "record_cap": f"{_with(VEHICLES)} select * from (select {VEHICLE_SEQ} as seq, accident_index from vehicles) numbered where seq < 500",
    "event_time_text": f"{_with(ACCIDENTS)} select accident_index, {ENVELOPE_TIME} as event_time from accidents",
    "envelope_encode": f"""{_with(ACCIDENTS)} select accident_index as key, {ACCIDENT_SEQ} as seq, 'accidents' as stream,
        {ENVELOPE_TIME} as event_time, accident_severity, "date", local_authority_district, speed_limit from accidents""",
    "envelope_encode_vehicles": f"""{_with(VEHICLES)} select accident_index as key, {VEHICLE_SEQ} as seq, 'vehicles' as stream,
        cast(null as varchar) as event_time, age_band_of_driver, sex_of_driver, vehicle_type, age_of_vehicle, "year" from vehicles""",
    "envelope_decode": f"""{_with(ACCIDENTS)} select {ACCIDENT_SEQ} as seq, 'accidents' as stream,
        {ENVELOPE_TIME} as event_time_str, accidents.* from accidents""",
    "envelope_decode_vehicles": f"""{_with(VEHICLES)} select {VEHICLE_SEQ} as seq, 'vehicles' as stream,
        cast(null as varchar) as event_time_str, vehicles.* from vehicles""",
    "extract_accidents": ACCIDENT_EXTRACT,
    "extract_vehicles": VEHICLE_EXTRACT,
    "union_extracts": VEHICLE_EXTRACT,
    "dates_valid": f"{_with(ACCIDENTS)} select accident_index, strftime({DAY}, '%Y-%m-%d') as event_date from accidents where {DAY} is not null",
    "geo_grid_cells": f"""{_with(ACCIDENTS)} select accident_index, cast(round(try_cast(latitude as decimal(18,6)), 1) as double) as lat_grid,
        cast(round(try_cast(longitude as decimal(18,6)), 1) as double) as lon_grid
        from accidents where try_cast(latitude as double) is not null and try_cast(longitude as double) is not null""",
    "severity_score": f"{_with(ACCIDENTS)} select accident_index, case accident_severity when 'Fatal' then 3 when 'Serious' then 2 else 1 end as score from accidents",
    "severity_weight": f"{_with(ACCIDENTS)} select accident_index, case accident_severity when 'Fatal' then 5 when 'Serious' then 3 else 1 end as weight from accidents",
    "tolerant_casts": f"""{_with(ACCIDENTS)} select accident_index, cast({_long('speed_limit')} as integer) as speed_limit,
        {_long('number_of_casualties')} as casualties, {_long('number_of_vehicles')} as vehicles from accidents""",
    "null_key_rejects": f"""{_with(ACCIDENTS)} select accident_index, case when {DAY} is null then 1 else 0 end as no_date,
        case when try_cast(speed_limit as double) is null then 1 else 0 end as no_speed
        from accidents where {DAY} is null or try_cast(speed_limit as double) is null""",
    "accident_kpi_geo": GEO_RESULT,
    "accident_conditions": CONDITION_RESULT,
    "accident_hotspots": HOTSPOT_RESULT,
    "vehicle_profile": PROFILE_RESULT,
    "vehicle_demographics": f"""{_with(ACCIDENTS, VEHICLES)} select '2024-01-01' as processing_date, {DEMOGRAPHIC_KEYS}, count(*) as joined_count
        from vehicles join accidents using (accident_index) group by {DEMOGRAPHIC_KEYS}""",
    "conditions_avg": f"{CONDITIONS} select {CONDITION_OUT}, accident_count, severity_sum, fatal_count, {AVG_SEVERITY} from conditions",
    "vehicle_profile_avg": f"{PROFILE} select {PROFILE_KEYS}, vehicle_count, age_of_vehicle_sum, age_of_vehicle_count, {AVG_AGE} from profile",
    "kpi_totals": f"{GEO} select {TOTALS} from geo",
    "table_stats": f"""{GEO}, {CONDITIONS.removeprefix(_with(ACCIDENTS) + ', ')}, {HOTSPOTS.removeprefix(_with(ACCIDENTS) + ', ')},
        {PROFILE.removeprefix('with ')},
        demographics as (select {DEMOGRAPHIC_KEYS} from vehicles join accidents using (accident_index) group by all)
        select {TOTALS}, count(*) as rows_kpi_geo, {ISO_STAMP.format('max(newest)')} as last_update,
        (select count(*) from conditions) as rows_conditions, (select count(*) from hotspots) as rows_hotspots,
        (select count(*) from profile) as rows_vehicle_profile, (select count(*) from demographics) as rows_demographics from geo""",
    "top_weather": f"{CONDITIONS} {TOP_WEATHER.format(10)}",
    "top_districts": f"{HOTSPOTS} {TOP_DISTRICTS}",
    "drivers_by_age_band": f"{PROFILE} {AGE_BANDS} limit 10",
    "district_leaderboard": f"{HOTSPOTS}, top as ({TOP_DISTRICTS}) select cast(row_number() over (order by weighted desc, district) as integer) as place, * from top",
    "latest_kpi_geo": f"{GEO}, newest_rows as (select * from geo order by newest desc, event_date, lat_grid, lon_grid limit 50) select {GEO_KEYS}, {GEO_MEASURES}, {STAMPED} from newest_rows",
    "latest_conditions": f"{CONDITIONS}, newest_rows as (select * from conditions order by newest desc, {CONDITION_KEYS} limit 50) select {CONDITION_OUT}, accident_count, severity_sum, fatal_count, {STAMPED}, {AVG_SEVERITY} from newest_rows",
    "latest_hotspots": f"{HOTSPOTS}, newest_rows as (select * from hotspots order by newest desc, {HOTSPOT_KEYS} limit 50) select {HOTSPOT_OUT}, weighted_count, accident_count, {STAMPED} from newest_rows",
    "latest_vehicle_profile": f"{PROFILE}, newest_rows as (select * from profile order by newest desc, {PROFILE_KEYS} limit 50) select {PROFILE_KEYS}, vehicle_count, age_of_vehicle_sum, age_of_vehicle_count, {STAMPED}, {AVG_AGE} from newest_rows",
    "latest_demographics": f"""{_with(ACCIDENTS, VEHICLES)},
        joined as (select cast(date '2024-01-01' + cast({_hash(4)} as integer) as timestamp) as day, {DEMOGRAPHIC_KEYS}
          from vehicles join accidents using (accident_index)),
        counted as (select day, {DEMOGRAPHIC_KEYS}, count(*) as joined_count from joined group by all)
        select strftime(day, '%Y-%m-%d') as processing_date, {DEMOGRAPHIC_KEYS}, joined_count, {ISO_STAMP.format('day')} as inserted_at
        from counted order by day desc, {DEMOGRAPHIC_KEYS} limit 50""",
    "stored_demographics": f"""{_with(ACCIDENTS, VEHICLES)},
        joined as (select strftime(date '2024-01-01' + cast({_hash(4)} as integer), '%Y-%m-%d') as processing_date, {DEMOGRAPHIC_KEYS}
          from vehicles join accidents using (accident_index))
        select processing_date, {DEMOGRAPHIC_KEYS}, count(*) as joined_count from joined group by all""",
    "accident_vehicle_join": f"""{_with(ACCIDENTS, VEHICLES)} select accident_index, age_band_of_driver, sex_of_driver, vehicle_type, accident_severity
        from vehicles join accidents using (accident_index)""",
    "bucketed_join": f"""{_with(ACCIDENTS, VEHICLES)} select accident_index, age_band_of_driver, sex_of_driver, vehicle_type, accident_severity
        from vehicles join accidents using (accident_index)""",
    "additive_merge": GEO_RESULT,
    "merge_freshness": f"{GEO} select {GEO_KEYS}, {STAMPED} from geo",
    "late_rows_merge": f"""{_with(ACCIDENTS, CONDITION_ROWS)},
        arrived as (select *, case when {_hash(5)} = 0 then 99 else extract(year from event_date) - 1990 end as arrival from condition_rows)
        select {CONDITION_OUT}, {CONDITION_SUMS},
        {ISO_STAMP.format("max(timestamp '2024-01-01 00:00:00' + to_hours(cast(arrival as integer)))")} as inserted_at
        from arrived group by {CONDITION_KEYS}""",
    "state_rows_touched": f"""{_with(ACCIDENTS, GEO_ROWS)},
        sliced as (select *, {_hash(4)} as slice from geo_rows),
        touched as (select event_date, lat_grid, lon_grid, {GEO_SUMS}, {NEWEST} from sliced s where slice < 3
          and exists (select 1 from sliced d where d.slice = 3 and d.event_date = s.event_date and d.lat_grid = s.lat_grid and d.lon_grid = s.lon_grid)
          group by 1, 2, 3)
        select {GEO_KEYS}, {GEO_MEASURES}, {STAMPED} from touched""",
    "stored_latest_kpi_geo": f"{GEO}, newest_rows as (select * from geo order by newest desc, event_date, lat_grid, lon_grid limit 50) select {GEO_KEYS}, {GEO_MEASURES}, {STAMPED} from newest_rows",
    "stored_rows_touched": f"""{_with(ACCIDENTS, GEO_ROWS)},
        sliced as (select *, {_hash(4)} as slice from geo_rows),
        touched as (select event_date, lat_grid, lon_grid, {GEO_SUMS}, {NEWEST} from sliced s where slice < 3
          and exists (select 1 from sliced d where d.slice = 3 and d.event_date = s.event_date and d.lat_grid = s.lat_grid and d.lon_grid = s.lon_grid)
          group by 1, 2, 3)
        select {GEO_KEYS}, {GEO_MEASURES}, {STAMPED} from touched""",
    "dedup_events": "select event_type as stream, event_id as seq, user_id, value, props from events",
    "stream_kpi_geo": GEO_RESULT,
    "stream_replayed_kpi_geo": GEO_RESULT,
    "stream_replayed_extract": VEHICLE_EXTRACT,
    "stream_restart_kpi_geo": GEO_RESULT,
    "stream_conditions": CONDITION_RESULT,
    "stream_hotspots": HOTSPOT_RESULT,
    "stream_vehicle_profile": PROFILE_RESULT,
    "stream_scores": f"""{_with(VEHICLES)} select accident_index, age_band_of_driver, sex_of_driver, vehicle_type,
        cast({_hash(2)} + 1 as integer) as model, cast(3 as integer) as ranked, cast(1 as double) as total from vehicles""",
    "stream_rejects": f"""{_with(ACCIDENTS)},
        sent as (select {_hash(7)} = 0 as bad, {DAY} is null as no_day, try_cast(latitude as double) is null or try_cast(longitude as double) is null as no_place,
          try_cast(speed_limit as double) is null as no_speed from accidents)
        select 'accident_kpi_geo' as target, count(*) as events, count(*) filter (where bad or no_day or no_place) as rejected from sent
        union all select 'accident_conditions', count(*), count(*) filter (where bad or no_day or no_speed) from sent
        union all select 'extract_accidents', count(*), count(*) filter (where bad) from sent""",
    "stream_demographics": f"""{_with(ACCIDENTS, VEHICLES)} select '2024-01-01' as processing_date, {DEMOGRAPHIC_KEYS}, count(*) as joined_count
        from vehicles join accidents using (accident_index) group by {DEMOGRAPHIC_KEYS}""",
    "stream_extract_accidents": ACCIDENT_EXTRACT,
    "stream_extract_vehicles": VEHICLE_EXTRACT,
    "clean_training_rows": f"{_with(ACCIDENTS, VEHICLES, CLEAN)} select * from clean",
    "training_groups": f"{FRAME} select * from groups",
    "bucketed_training_groups": f"{FRAME} select * from groups",
    "bucketed_split": f"{FRAME}, {SPLIT.strip()} select *, n - n_test as n_train from parts",
    "target_distribution": f"""{FRAME} select accident_severity, cast(sum(n) as bigint) as n,
        cast(sum(n) as double) / (select cast(sum(n) as double) from groups) as share from groups group by 1""",
    "feature_options": f"""{FRAME}, options as (
          select distinct 'age_band_of_driver' as feature, age_band_of_driver as value from groups
          union all select distinct 'sex_of_driver', sex_of_driver from groups
          union all select distinct 'vehicle_type', vehicle_type from groups)
        select feature, value, cast(row_number() over (partition by feature order by value) as integer) as place from options""",
    "train_test_counts": f"""{FRAME}, {SPLIT.strip()}
        select 'train' as part, accident_severity, cast(sum(n - n_test) as bigint) as n from parts group by 2
        union all select 'test', accident_severity, cast(sum(n_test) as bigint) from parts group by 2""",
    "class_weights": f"""{FRAME}, {SPLIT.strip()},
        counts as (select accident_severity, cast(sum(n - n_test) as bigint) as n from parts group by 1)
        select accident_severity, n, (select cast(sum(n) as double) from counts) / cast((select count(*) from counts) * n as double) as weight from counts""",
    "onehot_features": f"""{FRAME},
        ages as (select list(distinct age_band_of_driver order by age_band_of_driver) as known from groups),
        sexes as (select list(distinct sex_of_driver order by sex_of_driver) as known from groups),
        types as (select list(distinct vehicle_type order by vehicle_type) as known from groups),
        combinations as (select age_band_of_driver, sex_of_driver, vehicle_type, cast(sum(n) as bigint) as n from groups group by 1, 2, 3)
        select age_band_of_driver, sex_of_driver, vehicle_type, n,
          array_to_string([case when k = age_band_of_driver then '1' else '0' end for k in ages.known], '')
          || array_to_string([case when k = sex_of_driver then '1' else '0' end for k in sexes.known], '')
          || array_to_string([case when k = vehicle_type then '1' else '0' end for k in types.known], '') as slots
        from combinations, ages, sexes, types""",
    "severity_coefficients": f"""{MODEL}
        select accident_severity as severity, cast(s - 1 as integer) as slot, round(w[s + 1], 6) + 0 as weight
        from coefficients, (select unnest(range(slots)) as s from dims) places""",
    "model_accuracy": f"""{PREDICTED}
        select 'train' as part, round({ACCURACY.format("n - n_test")}, 9) as accuracy from predicted_parts
        union all select 'test', round({ACCURACY.format("n_test")}, 9) from predicted_parts""",
    "classification_report": f"""{PREDICTED},
        ruled as (select accident_severity as actual, n_test as n, predicted from predicted_parts where n_test > 0),
        {REPORT}""",
    "score_batch": f"""{MODEL}, cases as (select distinct age_band_of_driver, sex_of_driver, vehicle_type from vehicles), {CASES.strip()},
        ranks as (select age_band_of_driver, sex_of_driver, vehicle_type,
          string_agg(class || ' ' || cast(cast(round(p * 100, 4) as decimal(9, 4)) as varchar), ', ' order by p desc, class) as ranked
          from chances group by 1, 2, 3),
        tested as (select accident_severity, n_test, arg_max(class, (z, -label)) as predicted
          from parts join scores using (age_band_of_driver, sex_of_driver, vehicle_type)
          group by age_band_of_driver, sex_of_driver, vehicle_type, accident_severity, n_test)
        select accident_index, age_band_of_driver, sex_of_driver, vehicle_type, predicted as predicted_severity, ranked,
          (select cast(sum(n) as bigint) from parts) as model_n_samples,
          (select round({ACCURACY.format("n_test")}, 9) from tested) as model_accuracy_test
        from vehicles join best using (age_band_of_driver, sex_of_driver, vehicle_type)
        join ranks using (age_band_of_driver, sex_of_driver, vehicle_type)""",
    "rule_report": f"""{FRAME},
        ruled as (select accident_severity as actual, n,
          case when sex_of_driver = 'Male' then 'Slight' when age_band_of_driver < '26' then 'Serious' else 'Fatal' end as predicted from groups),
        {REPORT}""",
    "snapshot_document": f"""{GEO}, {CONDITIONS.removeprefix(_with(ACCIDENTS) + ', ')}, {HOTSPOTS.removeprefix(_with(ACCIDENTS) + ', ')},
        {PROFILE.removeprefix('with ')},
        stats as (select {TOTALS}, {ISO_STAMP.format('max(newest)')} as last_update from geo),
        cells as (select {GEO_KEYS}, accident_count, fatal_count
          from (select * from geo order by newest desc, event_date, lat_grid, lon_grid limit 100) newest_cells
          order by newest desc, newest_cells.event_date, newest_cells.lat_grid, newest_cells.lon_grid),
        districts as ({TOP_DISTRICTS}),
        top_weather as (select weather_conditions as weather, accidents, fatal from ({TOP_WEATHER.format(8)}) w order by accidents desc, weather),
        bands as ({AGE_BANDS})
        select cast(to_json({{'type': 'snapshot', 'ts': '2024-01-01T00:00:00.000000',
          'stats': (select stats from stats),
          'recent_geo': (select list(cells) from cells),
          'top_districts': (select list(districts) from districts),
          'top_weather': (select list(top_weather) from top_weather),
          'age_bands': (select list(bands) from bands)}}) as varchar) as document""",
    "batch_recompute": GEO_RESULT,
    "batch_recompute_conditions": CONDITION_RESULT,
    "batch_recompute_hotspots": HOTSPOT_RESULT,
    "batch_recompute_profile": PROFILE_RESULT,
    "serve_batch_or_stream": f"""{GEO} select {GEO_KEYS}, {GEO_MEASURES},
        case when event_date < date '1998-07-01' then '2024-01-01T00:00:00' else {ISO_STAMP.format('newest')} end as inserted_at,
        case when event_date < date '1998-07-01' then 'batch' else 'stream' end as layer from geo""",
}
