"""The queries as DuckDB SQL on the same tables.

Means are compared in single precision: the inputs have two decimals, so a mean of 2^n values is
often an exact tie for decimal rounding, and the order of a sum then decides its last digit.
"""

from __future__ import annotations

# Building blocks: named subqueries, put in front of a final SELECT in the order given.
PARTS = {
    "raw": """
        SELECT strftime(ts, '%Y%m%d') AS date, time_bucket(INTERVAL '5 minutes', ts) AS slot, ts,
               CAST(user_id AS VARCHAR) AS user_id, event_type, value,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k
        FROM events""",
    "gold": """
        SELECT date, slot AS datetime, event_type AS linkid, avg(value) AS v FROM raw GROUP BY ALL""",
    "silver": """
        SELECT date, slot AS datetime, user_id AS linkid, avg(value) AS v FROM raw GROUP BY ALL""",
    "grid": """
        SELECT s.linkid, s.datetime, g.v
        FROM (SELECT linkid, unnest(generate_series(min(datetime), max(datetime), INTERVAL '5 minutes')) AS datetime
              FROM gold GROUP BY linkid) s
        LEFT JOIN gold g USING (linkid, datetime)""",
    "prices": """
        SELECT CAST(l_suppkey AS VARCHAR) AS linkid, l_shipdate AS datetime, avg(l_extendedprice) AS v
        FROM lineitem GROUP BY ALL""",
    "daygrid": """
        SELECT s.linkid, s.datetime, p.v
        FROM (SELECT linkid, unnest(generate_series(min(datetime), max(datetime), INTERVAL '1 day')) AS datetime
              FROM prices GROUP BY linkid) s
        LEFT JOIN prices p USING (linkid, datetime)""",
    "rolled": """
        SELECT linkid, datetime, coalesce(v, avg(v) OVER (
            PARTITION BY linkid ORDER BY epoch_us(datetime)
            RANGE BETWEEN 929999999 PRECEDING AND 930000000 FOLLOWING)) AS v
        FROM grid""",
    "series": """
        SELECT linkid, datetime, coalesce(v, avg(v) OVER (
            PARTITION BY linkid, isodow(datetime), strftime(datetime, '%H:%M'))) AS v
        FROM rolled""",
    "sides_days": """
        SELECT *, datetime < (SELECT max(datetime) - INTERVAL '7 days' FROM series) AS in_train FROM series""",
    "sides_fraction": """
        SELECT linkid, datetime, v,
               row_number() OVER (ORDER BY datetime, linkid)
                   <= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM series) AS in_train
        FROM series""",
    "bounds": """
        SELECT min(datetime) FILTER (in_train) AS t0, max(datetime) FILTER (in_train) AS t1,
               min(datetime) FILTER (NOT in_train) AS v0, max(datetime) FILTER (NOT in_train) AS v1
        FROM sides""",
    "scaler": """
        SELECT linkid, coalesce(avg(v), 0) AS mu,
               CASE WHEN coalesce(stddev_pop(v), 0) = 0 THEN 1 ELSE stddev_pop(v) END AS sd
        FROM series, bounds WHERE datetime BETWEEN t0 AND t1 GROUP BY linkid""",
    "targets": """
        SELECT s.linkid, datetime, CAST((v - mu) / sd AS FLOAT)::DOUBLE AS z,
               CAST(((lead(v) OVER (PARTITION BY s.linkid ORDER BY datetime)) - mu) / sd AS FLOAT)::DOUBLE AS y
        FROM series s JOIN scaler c ON s.linkid = c.linkid""",
    "windows": """
        SELECT linkid, datetime AS end_time, y,
               count(*) OVER w AS length, count(z) OVER w AS filled,
               first_value(z) OVER w AS first_z, z AS last_z, sum(z) OVER w AS sum_z
        FROM targets WHERE y IS NOT NULL
        WINDOW w AS (PARTITION BY linkid ORDER BY datetime ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)""",
    "samples": """
        SELECT linkid, end_time, length, first_z, last_z, sum_z, y,
               end_time BETWEEN t0 AND t1 AS train, end_time BETWEEN v0 AND v1 AS validation
        FROM windows, bounds
        WHERE length = 36 AND filled = 36 AND (end_time BETWEEN t0 AND t1 OR end_time BETWEEN v0 AND v1)""",
    "threshold": "SELECT quantile_cont(y, 0.25) AS thr FROM samples WHERE train",
    "season": """
        SELECT linkid, isodow(datetime) AS wd, strftime(datetime, '%H:%M') AS hhmm, avg(v) AS m
        FROM series, bounds WHERE datetime BETWEEN t0 AND t1 GROUP BY ALL""",
    "metrics": """
        SELECT CAST(day(ts) AS INTEGER) AS step, avg(value) AS val_mae, max(value) AS train_mae
        FROM events GROUP BY ALL""",
}

_SERIES = ["raw", "gold", "grid", "rolled", "series"]
_SAMPLES = [*_SERIES, "sides_days=sides", "bounds", "scaler", "targets", "windows", "samples"]
_SAMPLES_FRACTION = [p.replace("sides_days", "sides_fraction") for p in _SAMPLES]


def _sql(parts: list[str], final: str) -> str:
    """WITH clause of the parts; ``part=name`` gives a part another name."""
    named = [(p.split("=")[-1], PARTS[p.split("=")[0]]) for p in parts]
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in named) + "\n" + final


_SCORES = """
    SELECT count(*) AS n, round(avg(abs(pred - y)), 4) AS mae,
           count(*) FILTER (pred <= thr AND y <= thr) AS tp,
           count(*) FILTER (pred <= thr AND y > thr) AS fp,
           count(*) FILTER (pred > thr AND y <= thr) AS fn,
           round(CASE WHEN count(*) FILTER (pred <= thr OR y <= thr) > 0
                 THEN 2.0 * count(*) FILTER (pred <= thr AND y <= thr)
                      / (count(*) FILTER (pred <= thr) + count(*) FILTER (y <= thr)) ELSE 0.0 END, 4) AS f1
    FROM guesses, threshold"""

_WINDOW_SCALARS = """
    SELECT linkid, end_time, CAST(length AS INTEGER) AS length, 5 AS width, round(first_z, 4) AS first_z,
           round(last_z, 4) AS last_z, round(sum_z, 4) AS sum_z, round(y, 4) AS y, train, validation
    FROM samples"""

# Five different measures: each is gridded, filled, scaled and windowed like the one above.
_FIVE = ("t2_mean", "t1_mean", "self_mean", "f1_mean", "f2_mean")


def _each(text: str) -> str:
    return ", ".join(text.format(c=c) for c in _FIVE)


PARTS |= {
    "gold5": """
        SELECT event_type AS linkid, slot AS datetime, min(value) AS t2_mean, max(value) AS t1_mean, avg(value) AS self_mean,
               avg(k) AS f1_mean, avg(value) FILTER (k % 2 = 1) AS f2_mean
        FROM raw GROUP BY ALL""",
    "grid5": f"""
        SELECT s.linkid, s.datetime, {_each("g.{c}")}
        FROM (SELECT linkid, unnest(generate_series(min(datetime), max(datetime), INTERVAL '5 minutes')) AS datetime
              FROM gold5 GROUP BY linkid) s
        LEFT JOIN gold5 g USING (linkid, datetime)""",
    "rolled5": f"""
        SELECT linkid, datetime, {_each("coalesce({c}, avg({c}) OVER w) AS {c}")} FROM grid5
        WINDOW w AS (PARTITION BY linkid ORDER BY epoch_us(datetime)
                     RANGE BETWEEN 929999999 PRECEDING AND 930000000 FOLLOWING)""",
    "series5": f"""
        SELECT linkid, datetime, {_each("coalesce({c}, avg({c}) OVER w) AS {c}")} FROM rolled5
        WINDOW w AS (PARTITION BY linkid, isodow(datetime), strftime(datetime, '%H:%M'))""",
    "sides5": """
        SELECT *, datetime < (SELECT max(datetime) - INTERVAL '7 days' FROM series5) AS in_train FROM series5""",
    "bounds5": """
        SELECT min(datetime) FILTER (in_train) AS t0, max(datetime) FILTER (in_train) AS t1,
               min(datetime) FILTER (NOT in_train) AS v0, max(datetime) FILTER (NOT in_train) AS v1 FROM sides5""",
    "scaler5": f"""
        SELECT linkid, {_each("coalesce(avg({c}), 0) AS mu_{c}")},
               {_each("CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1 ELSE stddev_pop({c}) END AS sd_{c}")}
        FROM series5, bounds5 WHERE datetime BETWEEN t0 AND t1 GROUP BY linkid""",
    "targets5": f"""
        SELECT s.linkid, datetime, {_each("(({c} - mu_{c}) / sd_{c})::FLOAT::DOUBLE AS z_{c}")},
               ((lead(self_mean) OVER (PARTITION BY s.linkid ORDER BY datetime) - mu_self_mean)
                / sd_self_mean)::FLOAT::DOUBLE AS y
        FROM series5 s JOIN scaler5 c ON s.linkid = c.linkid""",
    "placed5": """
        SELECT *, row_number() OVER (PARTITION BY linkid ORDER BY datetime) AS rn FROM targets5 WHERE y IS NOT NULL""",
    "windows5": f"""
        SELECT linkid, datetime AS end_time, y, count(*) OVER w AS length,
               {" + ".join(f"count(z_{c}) OVER w" for c in _FIVE)} AS filled,
               {_each("first_value(z_{c}) OVER w AS first_{c}, z_{c} AS last_{c}")},
               {_each("sum(rn * z_{c}) OVER w - (rn - 36) * sum(z_{c}) OVER w AS sum_{c}")}
        FROM placed5 WINDOW w AS (PARTITION BY linkid ORDER BY datetime ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)""",
}
_SERIES5 = ["raw", "gold5", "grid5", "rolled5", "series5"]
_WINDOWS5 = [*_SERIES5, "sides5", "bounds5", "scaler5", "targets5", "placed5", "windows5"]

_SILVER_ROWS = "SELECT datetime, linkid, v::FLOAT::DOUBLE AS self_mean, date FROM gold"

_DAY_TOTALS = "SELECT date, count(*) AS rows, round(sum(value), 2) AS total FROM raw GROUP BY date"

_DIRTY = """
    SELECT strftime(ts, '%Y%m%d') AS date, time_bucket(INTERVAL '5 minutes', ts) AS slot, event_type AS linkid, value
    FROM events WHERE event_id % 10 NOT IN (0, 1, 2)"""

_BRONZE = """
    SELECT date AS "CREATDE", strftime(ts, '%H%M') AS "CREATHM", user_id AS "LINKID",
           event_type AS "ROADINSTTCD", value AS "PASNGSPED", k AS "PASNGTIME", date FROM raw"""

ORACLE: dict[str, str] = {
    "silver_slot_mean": _sql(
        ["raw", "silver"], "SELECT datetime, date, linkid, v::FLOAT::DOUBLE AS self_mean FROM silver"
    ),
    "csv_scan_days": _sql(["raw"], _DAY_TOTALS),
    "land_zip": _sql(["raw"], _DAY_TOTALS),
    "bronze_plan": """
        SELECT CASE event_id % 10 WHEN 1 THEN strftime(ts + INTERVAL '1 day', '%Y%m%d') WHEN 2 THEN '20x51113'
                    ELSE strftime(ts, '%Y%m%d') END AS "CREATDE",
               CASE event_id % 10 WHEN 0 THEN '2599' WHEN 3 THEN CAST(hour(ts) * 100 + minute(ts) AS VARCHAR)
                    ELSE strftime(ts, '%H%M') END AS "CREATHM",
               event_type AS "LINKID", 'R' AS "ROADINSTTCD", value::FLOAT::DOUBLE AS "PASNGSPED",
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS "PASNGTIME", strftime(ts, '%Y%m%d') AS date
        FROM events""",
    "silver_plan": f"""
        SELECT date, slot AS datetime, linkid, avg(value)::FLOAT::DOUBLE AS self_mean FROM ({_DIRTY}) GROUP BY ALL""",
    "gold_plan": f"""
        SELECT date, slot AS datetime, linkid, avg(value)::FLOAT::DOUBLE AS self_mean FROM ({_DIRTY}) GROUP BY ALL""",
    "silver_delta": _sql(["raw", "gold"], _SILVER_ROWS),
    "stream_slots": _sql(["raw", "gold"], _SILVER_ROWS),
    "day_run": _sql([*_SAMPLES, "threshold"], """
        , sides_of AS (
            SELECT 'train' AS side, y, last_z FROM samples WHERE train
            UNION ALL SELECT 'validation', y, last_z FROM samples WHERE validation),
        counted AS (
            SELECT side, count(*) AS n, count(*) FILTER (y <= thr) AS positives, round(avg(abs(last_z - y)), 4) AS mae
            FROM sides_of, threshold GROUP BY side)
        SELECT 'persistence' AS model, side, n, positives, mae FROM counted
        UNION ALL SELECT 'l1', side, n, positives, NULL FROM counted"""),
    "zip_members": _sql(["raw"], "SELECT date, count(*) AS rows FROM raw GROUP BY date"),
    "bronze_cast": _sql(["raw"], _BRONZE),
    "lake_roundtrip": _sql(["raw"], _BRONZE),
    "filter_links": _sql(["raw"], """
        SELECT user_id AS "LINKID", date, count(*) AS rows FROM raw
        WHERE user_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier) GROUP BY ALL"""),
    "gold_conform": _sql(
        ["raw", "silver"], "SELECT date, datetime, linkid, v::FLOAT::DOUBLE AS self_mean FROM silver"
    ),
    "gold_five_channels": _sql(["raw", "gold"], """
        SELECT datetime, linkid, v::FLOAT::DOUBLE AS t2_mean, v::FLOAT::DOUBLE AS t1_mean, v::FLOAT::DOUBLE AS self_mean,
               v::FLOAT::DOUBLE AS f1_mean, v::FLOAT::DOUBLE AS f2_mean FROM gold"""),
    "gold_replace_days": _sql(["raw", "gold"], """
        SELECT date, datetime, linkid,
               (CASE WHEN date = (SELECT min(date) FROM gold) THEN v + 1000 ELSE v END)::FLOAT::DOUBLE AS self_mean
        FROM gold"""),
    "gold_snapshot": _sql(["raw", "gold"], """
        , ends AS (SELECT min(date) AS first, max(date) AS last FROM gold)
        SELECT date, datetime, linkid, (v + 1000)::FLOAT::DOUBLE AS self_mean, 1 AS snapshot FROM gold
        UNION ALL
        SELECT date, datetime, linkid, (CASE WHEN date = first THEN v + 1000 ELSE v END)::FLOAT::DOUBLE, 2
        FROM gold, ends WHERE date <> last"""),
    "pending_days": _sql(["raw"], """
        SELECT strftime(d, '%Y%m%d') AS date
        FROM (SELECT unnest(generate_series(max(ts)::DATE - 364, max(ts)::DATE, INTERVAL '1 day')) AS d FROM raw)
        WHERE strftime(d, '%Y%m%d') NOT IN (SELECT date FROM raw)"""),
    "file_events_json": """
        WITH named AS (SELECT url, html, regexp_extract(rtrim(url, '/'), '([^/]*)$', 1) AS name FROM pages),
        headed AS (SELECT *, CASE WHEN contains(name, '_') THEN split_part(name, '_', 1)
                                  ELSE split_part(name, '.', 1) END AS head FROM named)
        SELECT CASE WHEN regexp_full_match(head, '[0-9]{8}') THEN head ELSE 'unknown_date' END AS date,
               'lake' AS bucket, 'raw/' || url AS key, CAST(octet_length(encode(html)) AS BIGINT) AS size
        FROM headed""",
    "parse_mixed_ts": """
        SELECT event_id, CASE WHEN event_id % 16 < 9 THEN date_trunc('second', ts)
                              WHEN event_id % 16 < 11 THEN date_trunc('minute', ts)
                              WHEN event_id % 16 < 15 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS datetime
        FROM events""",
    "day_from_path": _sql(["raw"], """
        SELECT CASE WHEN event_type IN ('click', 'view') THEN date ELSE 'unknown_date' END AS date, count(*) AS rows
        FROM raw GROUP BY ALL"""),
    "trailing_range": """
        SELECT DISTINCT strftime(ts, '%Y%m%d') AS date, CAST(day(ts) - 2 AS INTEGER) AS days,
               strftime(ts::DATE - CAST(greatest(day(ts) - 2, 1) - 1 AS INTEGER), '%Y%m%d') AS first_day,
               strftime(ts, '%Y%m%d') AS last_day
        FROM events""",
    "row_counts": _sql(["raw"], """
        SELECT date, event_type AS "ROADINSTTCD", count(*) AS rows FROM raw GROUP BY ALL"""),
    "time_span": _sql(["prices"], """
        SELECT linkid, min(datetime) AS first, max(datetime) AS last,
               CAST(date_diff('day', min(datetime), max(datetime)) + 1 AS INTEGER) AS total_days
        FROM prices GROUP BY linkid"""),
    "dedupe_mean": """
        SELECT event_type AS linkid, date_trunc('minute', ts) AS datetime, avg(value)::FLOAT::DOUBLE AS self_mean
        FROM events GROUP BY ALL""",
    "dedupe_mean_days": _sql(["prices"], "SELECT linkid, datetime, v::FLOAT::DOUBLE AS self_mean FROM prices"),
    "complete_grid": _sql(
        ["raw", "gold", "grid"], "SELECT linkid, datetime, v::FLOAT::DOUBLE AS self_mean FROM grid"
    ),
    "complete_grid_days": _sql(
        ["prices", "daygrid"], "SELECT linkid, datetime, v::FLOAT::DOUBLE AS self_mean FROM daygrid"
    ),
    "impute_rolling": _sql(
        ["raw", "gold", "grid", "rolled"], "SELECT linkid, datetime, v::FLOAT::DOUBLE AS self_mean FROM rolled"
    ),
    "impute_rolling_days": _sql(["prices", "daygrid"], """
        SELECT linkid, datetime, coalesce(v, avg(v) OVER (PARTITION BY linkid ORDER BY epoch_us(datetime)
            RANGE BETWEEN 302399999999 PRECEDING AND 302400000000 FOLLOWING))::FLOAT::DOUBLE AS self_mean
        FROM daygrid"""),
    "impute_seasonal": _sql(["raw", "gold", "grid"], """
        SELECT linkid, datetime, coalesce(v, avg(v) OVER (
            PARTITION BY linkid, isodow(datetime), strftime(datetime, '%H:%M')))::FLOAT::DOUBLE AS self_mean FROM grid"""),
    "impute": _sql(_SERIES, "SELECT linkid, datetime, v::FLOAT::DOUBLE AS self_mean FROM series"),
    "impute_channels": _sql(_SERIES, """
        SELECT linkid, datetime, v::FLOAT::DOUBLE AS t2_mean, v::FLOAT::DOUBLE AS t1_mean, v::FLOAT::DOUBLE AS self_mean,
               v::FLOAT::DOUBLE AS f1_mean, v::FLOAT::DOUBLE AS f2_mean FROM series"""),
    "split_days": _sql([*_SERIES, "sides_days=sides"], """
        SELECT linkid, datetime, CASE WHEN in_train THEN 'train' ELSE 'validation' END AS side FROM sides"""),
    "split_fraction": _sql([*_SERIES, "sides_fraction=sides"], """
        SELECT linkid, datetime, CASE WHEN in_train THEN 'train' ELSE 'validation' END AS side FROM sides"""),
    "split_fraction_numeric": """
        WITH prices AS (SELECT DISTINCT l_suppkey AS linkid, CAST(l_shipdate AS TIMESTAMP) AS datetime FROM lineitem)
        SELECT linkid, datetime,
               CASE WHEN row_number() OVER (ORDER BY datetime, CAST(linkid AS VARCHAR))
                         <= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM prices)
                    THEN 'train' ELSE 'validation' END AS side
        FROM prices""",
    "restrict_links": _sql(["raw", "silver"], """
        , cut AS (SELECT max(datetime) - INTERVAL '28 days' AS c FROM silver)
        SELECT datetime, date, linkid, v::FLOAT::DOUBLE AS self_mean FROM silver, cut
        WHERE datetime >= c AND linkid IN (SELECT linkid FROM silver, cut WHERE datetime < c)"""),
    "scaler": _sql([*_SERIES, "sides_days=sides", "bounds", "scaler"], """
        SELECT linkid, mu::FLOAT::DOUBLE AS self_mean_mu, sd::FLOAT::DOUBLE AS self_mean_sd FROM scaler"""),
    "standardise": _sql([*_SERIES, "sides_days=sides", "bounds", "scaler"], """
        SELECT linkid, datetime, ((v - mu) / sd)::FLOAT::DOUBLE AS self_mean FROM series JOIN scaler USING (linkid)"""),
    "horizon_target": _sql(["raw", "gold", "grid"], """
        SELECT linkid, datetime, v::FLOAT::DOUBLE AS self_mean,
               (lead(v, 3) OVER (PARTITION BY linkid ORDER BY datetime))::FLOAT::DOUBLE AS target FROM grid"""),
    "sequences": _sql(_SAMPLES, _WINDOW_SCALARS),
    "sequences_fraction": _sql(_SAMPLES_FRACTION, _WINDOW_SCALARS),
    "impute_measures": _sql(_SERIES5, f"SELECT linkid, datetime, {_each('{c}::FLOAT::DOUBLE AS {c}')} FROM series5"),
    "sequences_channels": _sql(_WINDOWS5, f"""
        SELECT linkid, end_time, CAST(length AS INTEGER) AS length, round(y, 3) AS y,
               {_each("round(first_{c}, 3) AS first_{c}, round(last_{c}, 3) AS last_{c}, round(sum_{c}, 3) AS sum_{c}")},
               end_time BETWEEN t0 AND t1 AS train, end_time BETWEEN v0 AND v1 AS validation
        FROM windows5, bounds5
        WHERE length = 36 AND filled = 5 * 36 AND (end_time BETWEEN t0 AND t1 OR end_time BETWEEN v0 AND v1)"""),
    "fit_steps": _sql(_SAMPLES, """
        SELECT CAST(unnest(range(8)) AS INTEGER) AS step, true AS finite, true AS falls, start_mae, train_samples, val_samples
        FROM (SELECT round(avg(abs(last_z - y)) FILTER (validation), 4) AS start_mae,
                     count(*) FILTER (train) AS train_samples, count(*) FILTER (validation) AS val_samples FROM samples)"""),
    "target_threshold": _sql([*_SAMPLES, "threshold"], """
        SELECT (SELECT count(*) FROM samples WHERE train) AS samples, round(thr, 4) AS threshold FROM threshold"""),
    "shuffle_samples": _sql(_SAMPLES, "SELECT linkid, end_time, round(y, 4) AS y FROM samples WHERE train"),
    "trailing_moments": _sql(["raw", "gold"], """
        , days AS (SELECT DISTINCT linkid, datetime::DATE AS day FROM gold)
        SELECT d.linkid, strftime(d.day, '%Y%m%d') AS day, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd
        FROM days d JOIN gold g ON g.linkid = d.linkid AND g.datetime::DATE BETWEEN d.day - 6 AND d.day GROUP BY ALL"""),
    "trailing_threshold": _sql(["raw", "gold"], """
        , days AS (SELECT DISTINCT datetime::DATE AS day FROM gold WHERE v IS NOT NULL)
        SELECT strftime(d.day, '%Y%m%d') AS day, count(v) AS n, round(quantile_cont(v, 0.25), 6) AS threshold
        FROM days d JOIN gold g ON g.datetime::DATE BETWEEN d.day - 6 AND d.day GROUP BY ALL"""),
    "epoch_order": _sql(_SAMPLES, """
        SELECT CAST(unnest(range(3)) AS INTEGER) AS epoch, n AS samples, n AS places, 0::BIGINT AS lowest, n - 1 AS highest,
               CAST(n * (n - 1) // 2 AS BIGINT) AS total, CAST(ceil(n / 64) AS BIGINT) AS batches
        FROM (SELECT count(*) AS n FROM samples WHERE train)"""),
    "eval_persistence": _sql([*_SAMPLES, "threshold"], """
        , guesses AS (SELECT y, last_z AS pred FROM samples WHERE validation)""" + _SCORES),
    "eval_seasonal_naive": _sql([*_SAMPLES, "threshold", "season"], """
        , guesses AS (
            SELECT y, coalesce((m - mu) / sd, 0) AS pred
            FROM (SELECT *, end_time + INTERVAL '5 minutes' AS t FROM samples WHERE validation) s
            JOIN scaler USING (linkid)
            LEFT JOIN season n ON n.linkid = s.linkid AND n.wd = isodow(t) AND n.hhmm = strftime(t, '%H:%M'))"""
        + _SCORES),
    "metrics_long": _sql(["metrics"], """
        SELECT 'run' AS run_id, step, name, value::FLOAT::DOUBLE AS value
        FROM (UNPIVOT metrics ON val_mae, train_mae INTO NAME name VALUE value)"""),
    "best_step": _sql(["metrics"], """
        SELECT 'run' AS run_id, step, val_mae::FLOAT::DOUBLE AS value FROM metrics ORDER BY val_mae, step LIMIT 1"""),
}
