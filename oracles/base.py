"""Common table expressions and text helpers for the oracle queries."""

from __future__ import annotations

import re

from oracles import lists as ft

AS_OF = "date '2030-01-01'"


def rnd(x: str, digits: int = 6) -> str:
    """Half away from zero with the same nudge at ties as the engine's own rounding."""
    scale = f"{10**digits}e0"
    return f"(round(({x}) * {scale} + sign({x}) * 1e-6) / {scale} + 0e0)"


def cols(spec: str, digits: int = 6) -> str:
    """``a i, b f, c d, e`` to a select list: integers, rounded doubles, dates as text, as is.
    ``f2`` rounds to two digits. A name may be ``expression as name``-free only."""
    out = []
    for item in spec.split(","):
        name, *kind = item.split()
        k = kind[0] if kind else ""
        if k == "i":
            out.append(f"cast({name} as bigint) as {name}")
        elif k.startswith("f"):
            out.append(f"{rnd(f'cast({name} as double)', int(k[1:] or digits))} as {name}")
        elif k == "d":
            out.append(f"cast({name} as varchar) as {name}")
        else:
            out.append(name)
    return ", ".join(out)


CTES: dict[str, str] = {}

CTES["readings"] = """
select event_id, event_type || '_' || event_id as record_id, ts as datetime, event_type as location_name,
  cast(length(event_type) * 2.5e0 as double) as latitude, cast(100e0 + length(event_type) as double) as longitude,
  if(event_id % 17 = 0, null, value / 5e0 - 10e0) as temperature,
  if(event_id % 19 = 0, null, k * 1.25e0 - 5e0) as humidity,
  if(event_id % 23 = 0, null, value / 10e0 - 0.5e0) as precipitation,
  if(event_id % 29 = 0, null, k * 1.25e0 + 940e0) as pressure,
  value * 0.5e0 - 1e0 as wind_speed, cast((user_id * 37) % 360 as double) as wind_direction, k as cloud_cover,
  cast(ts as date) as extract_date
from (select *, cast(json_extract_string(props, '$.k') as double) as k from events)"""

CTES["shipments"] = """
select l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey as record_id,
  l_shipdate + to_hours(cast((l_orderkey * 7 + l_linenumber) % 24 as integer)) as datetime,
  case l_returnflag when 'A' then 'Hanoi' when 'N' then 'Ho Chi Minh City' else 'Da Nang' end as location_name,
  cast(ascii(l_returnflag) - 50 as double) as latitude, cast(ascii(l_returnflag) + 30 as double) as longitude,
  l_quantity * 0.25e0 + 16e0 + abs(m - 1) * 0.5e0 as temperature,
  l_discount * 400e0 + 45e0 + m as humidity,
  greatest(0e0, l_tax * 100e0 + (m - 9)) as precipitation,
  (l_partkey % 400) * 0.1e0 + 990e0 as pressure,
  (l_suppkey % 37) * 0.75e0 as wind_speed,
  cast((l_partkey * 37) % 360 as double) as wind_direction,
  cast(l_orderkey % 101 as double) as cloud_cover,
  cast(l_shipdate as date) as extract_date
from (select *, month(l_shipdate) as m from lineitem)"""


def _chain(prefix: str, source: str, tie: str) -> None:
    """staged, checked, enriched, daily, features over a readings source."""
    p = prefix
    CTES[f"{p}staged"] = f"""
select *, cast(datetime as date) as date, hour(datetime) as hour, day(datetime) as day, month(datetime) as month,
  year(datetime) as year, dayofweek(datetime) as day_of_week, week(datetime) as week_of_year, quarter(datetime) as quarter,
  temperature is null as no_t, humidity is null as no_h, precipitation is null as no_p
from {source} where datetime is not null and location_name is not null"""
    CTES[f"{p}flagged"] = f"""
select *, {FLAG_LIST} from {p}staged"""
    CTES[f"{p}cleaned"] = f"""
select * replace (if(temp_outlier_flag = 1, null, temperature) as temperature,
  if(humidity_outlier_flag = 1, null, humidity) as humidity,
  if(precip_outlier_flag = 1, 0e0, precipitation) as precipitation,
  if(pressure_outlier_flag = 1, null, pressure) as pressure,
  if(wind_speed_outlier_flag = 1, null, wind_speed) as wind_speed) from {p}flagged"""
    near = f"over (partition by location_name, date order by datetime, {tie} rows between 2 preceding and 2 following)"
    CTES[f"{p}filled"] = f"""
select * replace (coalesce(temperature, avg(temperature) {near}) as temperature,
  coalesce(humidity, avg(humidity) {near}) as humidity, coalesce(precipitation, 0e0) as precipitation,
  coalesce(pressure, avg(pressure) {near}) as pressure, coalesce(wind_speed, avg(wind_speed) {near}) as wind_speed)
from {p}cleaned"""
    CTES[f"{p}checked"] = f"""
select * from (select *, 100 - 20 * ({FLAG_SUM}) as data_quality_score from {p}filled) where data_quality_score >= 60"""
    CTES[f"{p}enriched"] = f"""
select *, {SEASON} as season, {PART} as part, {CONDITIONS},
  temperature + humidity / 100e0 * 5 as temp_humidity_index, temperature - wind_speed / 10e0 as wind_chill_index
from {p}checked"""
    rounded = ", ".join(f"{rnd(sql, 2)} as {name}" for name, sql in DAILY.items())
    counted = ", ".join(f"cast(sum({flag}) as bigint) as {name}" for name, flag in HOURS.items())
    CTES[f"{p}daily"] = f"""
select md5(location_name || '-' || date) as daily_id, location_name, date, dayofweek(date) as day_of_week,
  dayname(date) as day_name, month(date) as month, monthname(date) as month_name, year(date) as year,
  quarter(date) as quarter, {SEASON.replace('month', 'month(date)')} as season,
  cast(dayofweek(date) in (0, 6) as integer) as is_weekend, {rounded}, {counted}, count(*) as total_hourly_records
from {p}enriched where date <= {AS_OF} group by location_name, date"""
    by = "(partition by location_name order by date"
    lags = ", ".join(f"lag({c}, {k}) over {by}) as {s}_lag_{k}d" for s, c, ks in ft.LAGS for k in ks)
    rolls = ", ".join(
        f"{agg}({c}) over {by} rows between {n} preceding and 1 preceding) as {name}" for name, agg, c, n in ft.ROLLING
    )
    CTES[f"{p}windowed"] = f"select *, {lags}, {rolls} from {p}daily"
    diffs = ", ".join(f"{rnd(f'({a} - {b}) / {d}e0', 2)} as {n}" for n, a, b, d in ft.DIFFERENCES)
    vols = ", ".join(f"{rnd(src, 2)} as {n}" for n, src in ft.VOLATILITY)
    plain = ", ".join(n if n in ft.WHOLE_NUMBERS else f"{rnd(n, 2)} as {n}" for n in ft.LAG_NAMES + ft.ROLLING_NAMES)
    CTES[f"{p}features"] = f"""
select md5(location_name || '-' || date) as feature_id, location_name, date, month, year, quarter, day_of_week,
  is_weekend, season, avg_temperature, {plain}, {diffs}, {vols}
from {p}windowed where temp_lag_1d is not null and date <= {AS_OF}"""


FLAGS = {
    "temp_outlier_flag": "temperature not between -50 and 60",
    "humidity_outlier_flag": "humidity not between 0 and 100",
    "precip_outlier_flag": "precipitation < 0",
    "pressure_outlier_flag": "pressure not between 950 and 1050",
    "wind_speed_outlier_flag": "wind_speed not between 0 and 150",
}
FLAG_LIST = ", ".join(f"cast(coalesce({test}, false) as integer) as {name}" for name, test in FLAGS.items())
FLAG_SUM = " + ".join(FLAGS)
SEASON = "if(month between 5 and 10, 'Rainy Season', 'Dry Season')"
PART = "if(hour < 5 or hour > 20, 'Night', if(hour < 12, 'Morning', if(hour < 17, 'Afternoon', 'Evening')))"
CONDITION_TESTS = {
    "is_raining": "precipitation > 0",
    "is_hot": "temperature > 32",
    "is_cold": "temperature < 20",
    "is_humid": "humidity > 80",
    "is_windy": "wind_speed > 20",
    "is_cloudy": "cloud_cover > 70",
}
CONDITIONS = ", ".join(f"cast(coalesce({test}, false) as bigint) as {name}" for name, test in CONDITION_TESTS.items())
DAILY = {
    "avg_temperature": "avg(temperature)", "max_temperature": "max(temperature)", "min_temperature": "min(temperature)",
    "temp_std_dev": "stddev_samp(temperature)", "temp_range": "max(temperature) - min(temperature)",
    **{f"{p.lower()}_temp": f"avg(temperature) filter (part = '{p}')" for p in ("Morning", "Afternoon", "Evening", "Night")},
    "total_precipitation": "sum(precipitation)", "max_hourly_precipitation": "max(precipitation)",
    "avg_precipitation": "avg(precipitation)",
    "avg_wind_speed": "avg(wind_speed)", "max_wind_speed": "max(wind_speed)", "min_wind_speed": "min(wind_speed)",
    "dominant_wind_direction": "avg(wind_direction)",
    "avg_humidity": "avg(humidity)", "max_humidity": "max(humidity)", "min_humidity": "min(humidity)",
    "avg_pressure": "avg(pressure)", "max_pressure": "max(pressure)", "min_pressure": "min(pressure)",
    "avg_cloud_cover": "avg(cloud_cover)", "avg_temp_humidity_index": "avg(temp_humidity_index)",
    "avg_wind_chill_index": "avg(wind_chill_index)", "avg_data_quality_score": "avg(data_quality_score)",
}
HOURS = {
    "hours_with_rain": "is_raining", "hours_hot": "is_hot", "hours_cold": "is_cold", "hours_humid": "is_humid",
    "hours_windy": "is_windy", "hours_cloudy": "is_cloudy",
}
_chain("", "readings", "event_id")
_chain("l", "shipments", "record_id")

CTES["orders_daily"] = """
select o_orderpriority as location_name, cast(o_orderdate as date) as date, sum(o_totalprice) as total_price,
  avg(o_totalprice) as avg_price, count(*) as orders from orders group by all"""
CTES["parted"] = """
select *, if(datediff('day', date '1970-01-01', date) < cut, 'train', 'test') as split
from lfeatures, (select quantile_cont(cast(datediff('day', date '1970-01-01', date) as double), 0.8) as cut from lfeatures)"""


def needed(text: str) -> list[str]:
    """The expressions a text refers to, each after those it builds on."""
    found: list[str] = []
    for word in re.findall(r"[a-z_]+", text):
        if word in CTES and word not in found:
            for inner in needed(CTES[word]):
                if inner not in found:
                    found.append(inner)
            found.append(word)
    return found


def full(body: str, **extra: str) -> str:
    """``body`` with every table expression it needs; ``extra`` adds local ones, in order."""
    text = " ".join([*extra.values(), body])
    parts = [f"{name} as materialized ({CTES[name]})" for name in needed(text)]
    parts += [f"{name} as {'materialized ' if name.startswith('m_') else ''}({sql})" for name, sql in extra.items()]
    recursive = "recursive " if any(name in re.findall(r"[a-z_]+", sql) for name, sql in extra.items()) else ""
    return f"with {recursive}{', '.join(parts)} {body}" if parts else body


# -- tail probabilities by Simpson's rule, as scalar expressions over outer columns ------------

_STEPS = 4000


def _simpson(density: str, upper: str) -> str:
    """Integral of ``density`` (in x) from 0 to ``upper``."""
    weight = f"if(i = 0 or i = {_STEPS}, 1, if(i % 2 = 1, 4, 2))"
    return (
        f"list_sum(list_transform(range(0, {_STEPS + 1}), lambda i: {weight} * "
        + density.replace("{x}", f"(i * ({upper}) / {_STEPS}e0)")
        + f")) * ({upper}) / {_STEPS * 3}e0"
    )


# The coefficients of Wichura's algorithm AS 241, constant term first.
AS241 = {
    "centre": (
        "3.3871328727963666080e0 1.3314166789178437745e2 1.9715909503065514427e3 1.3731693765509461125e4 "
        "4.5921953931549871457e4 6.7265770927008700853e4 3.3430575583588128105e4 2.5090809287301226727e3",
        "1e0 4.2313330701600911252e1 6.8718700749205790830e2 5.3941960214247511077e3 "
        "2.1213794301586595867e4 3.9307895800092710610e4 2.8729085735721942674e4 5.2264952788528545610e3",
    ),
    "shoulder": (
        "1.42343711074968357734e0 4.63033784615654529590e0 5.76949722146069140550e0 3.64784832476320460504e0 "
        "1.27045825245236838258e0 2.41780725177450611770e-1 2.27238449892691845833e-2 7.74545014278341407640e-4",
        "1e0 2.05319162663775882187e0 1.67638483018380384940e0 6.89767334985100004550e-1 "
        "1.48103976427480074590e-1 1.51986665636164571966e-2 5.47593808499534494600e-4 1.05075007164441684324e-9",
    ),
    "tail": (
        "6.65790464350110377720e0 5.46378491116411436990e0 1.78482653991729133580e0 2.96560571828504891230e-1 "
        "2.65321895265761230930e-2 1.24266094738807843860e-3 2.71155556874348757815e-5 2.01033439929228813265e-7",
        "1e0 5.99832206555887937690e-1 1.36929880922735805310e-1 1.48753612908506148525e-2 "
        "7.86869131145613259100e-4 1.84631831751005468180e-5 1.42151175831644588870e-7 2.04426310338993978564e-15",
    ),
}


def poly(coefficients: str, x: str) -> str:
    """Constant term first."""
    return " + ".join(f"({c}) * pow({x}, {i})" for i, c in enumerate(coefficients.split()))


def normal_quantile(p: str) -> str:
    ratio = {part: lambda r, a=a, b=b: f"(({poly(a, r)}) / ({poly(b, r)}))" for part, (a, b) in AS241.items()}
    r = f"sqrt(-ln(least({p}, 1 - ({p}))))"
    q = f"(({p}) - 0.5e0)"
    outer = f"if({r} <= 5, {ratio['shoulder'](f'({r} - 1.6e0)')}, {ratio['tail'](f'({r} - 5e0)')})"
    return f"if(abs({q}) <= 0.425e0, {q} * {ratio['centre'](f'(0.180625e0 - {q} * {q})')}, sign({q}) * {outer})"


def p_normal(z: str) -> str:
    return f"(1 - 2 * {_simpson('exp(-{x} * {x} / 2) / sqrt(2 * pi())', f'least(abs({z}), 12)')})"


def p_t(t: str, v: str) -> str:
    density = f"exp(lgamma((({v}) + 1) / 2e0) - lgamma(({v}) / 2e0)) / sqrt(({v}) * pi()) * pow(1 + {{x}} * {{x}} / ({v}), -(({v}) + 1) / 2e0)"
    return f"(1 - 2 * {_simpson(density, f'least(abs({t}), 60)')})"
