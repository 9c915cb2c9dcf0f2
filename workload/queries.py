"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadspeed.functions import day_from_path, is_finite, parse_mixed_ts, trailing_range
from roadspeed.operators import (
    add_target,
    best_step,
    complete_grid,
    conform_gold,
    dedupe_mean,
    epoch_order,
    evaluate,
    expand_channels,
    filter_links,
    fit_scaler,
    fit_steps,
    five_channels,
    impute,
    impute_rolling,
    impute_seasonal,
    persistence,
    restrict_links,
    row_counts,
    seasonal_naive,
    shuffle_samples,
    split_by_time,
    standardise,
    time_span,
    to_bronze,
)
from roadspeed.operators.trailing import (
    daily_moments, daily_sketches, deviation, trailing_moments, trailing_percentiles,
)
from roadspeed.plans import (
    LakeConfig, TrainConfig, TrainingSet, prepare_series, run_range, train_and_score, training_set,
)
from roadspeed.operators.gold import CHANNELS
from roadspeed.operators.sequences import channel_values
from roadspeed.operators.readings import BRONZE_SCHEMA, SILVER_SCHEMA
from roadspeed.plans.lake import bronze_to_silver, gold_rows, raw_to_bronze, silver_to_gold, zone_rows
from roadspeed.plans.slots import refresh_silver
from roadspeed.session import materialise, scratch_path
from roadspeed.sinks import land_zip, metrics_table, write_days
from roadspeed.sources import day_range, landed_days, pending_days, read_days, read_raw_csv, read_zip_members
from roadspeed.streaming import EVENT_SCHEMA, event_values, file_events
from roadspeed.streaming.slots import stream_slots
from roadspeed.versions import VersionedDays
from workload.adapters import (
    dirty_readings,
    channels_by_type,
    csv_files,
    csv_lake,
    first_last_day,
    gold_by_type,
    price_series,
    raw_by_type,
    raw_by_user,
    silver,
    table,
    zip_archives,
)

VALUE = "self_mean"
DAYS_CONFIG = TrainConfig(val_days=7)
FRACTION_CONFIG = TrainConfig(val_days=30)


def _plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Comparable output: doubles in single precision or rounded, timestamps without zone."""

    def tidy(name: str, kind: str) -> Column:
        if kind in ("double", "float"):
            value = F.col(name).cast("float").cast("double")
            return (value if digits is None else F.round(F.col(name).cast("double"), digits)).alias(name)
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    return df.select(*[tidy(n, k) for n, k in df.dtypes])


# -- sources and sinks ---------------------------------------------------------------------------


def csv_scan_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_by_type(spark, sf_dir)
    back = to_bronze(read_raw_csv(spark, csv_lake(raw), *first_last_day(raw)))
    return _plain(
        back.groupBy("date").agg(F.count("LINKID").alias("rows"), F.sum("PASNGSPED").alias("total")), 2
    )


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_by_type(spark, sf_dir)
    first, last = first_last_day(raw)
    # A year back from the last landed day.
    start = spark.range(1).select(trailing_range(F.lit(last), 365)[0]).first()[0]
    return pending_days(day_range(spark, start, last), landed_days(spark, csv_lake(raw)))


def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_zip_members(spark, zip_archives(raw_by_user(spark, sf_dir)))
    return lines.filter("line_no > 1").groupBy("date").agg(F.count("line").alias("rows"))


def zip_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_by_user(spark, sf_dir)
    lake = scratch_path(spark, "raw")
    land_zip(spark, zip_archives(raw), lake)
    back = to_bronze(read_raw_csv(spark, lake, *first_last_day(raw)))
    return _plain(back.groupBy("date").agg(F.count("LINKID").alias("rows"), F.sum("PASNGSPED").alias("total")), 2)


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = to_bronze(raw_by_user(spark, sf_dir))
    base = scratch_path(spark, "bronze")
    for _ in range(2):
        write_days(bronze, base, files_per_day=8, by="CREATHM")
    return read_days(spark, base, *first_last_day(bronze), schema=bronze.schema)


def gold_replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days hold old values, then every day but the first is replaced."""
    gold = gold_by_type(spark, sf_dir)
    first, last = first_last_day(gold)
    base = scratch_path(spark, "gold")
    write_days(gold.withColumn(VALUE, F.col(VALUE) + 1000), base)
    write_days(gold.filter(F.col("date") != first), base)
    return _plain(read_days(spark, base, first, last, schema=gold.schema))


def gold_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days hold old values; then all but the first are replaced at once and the last is emptied. Both snapshots."""
    gold = gold_by_type(spark, sf_dir)
    first, last = first_last_day(gold)
    days = VersionedDays(spark, scratch_path(spark, "gold"))
    days.write(gold.withColumn(VALUE, F.col(VALUE) + 1000))
    days.write(gold.filter(~F.col("date").isin(first, last)), [last])
    both = [days.read(first, last, gold.schema, n).withColumn("snapshot", F.lit(n)) for n in (1, 2)]
    return _plain(both[0].unionByName(both[1]))


def file_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = table(spark, sf_dir, "pages").select(
        day_from_path("url").alias("date"), F.col("url").alias("key"), F.octet_length("html").alias("size")
    )
    messages = event_values(file_events(landed, "lake", "raw"))
    return messages.select(F.from_json("value", EVENT_SCHEMA).alias("e")).select("e.*")


# -- readings ------------------------------------------------------------------------------------


def bronze_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(raw_by_user(spark, sf_dir))


def silver_slot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(silver(raw_by_user(spark, sf_dir)))


def link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = table(spark, sf_dir, "supplier").select("s_suppkey")
    kept = filter_links(raw_by_user(spark, sf_dir), allowed)
    return row_counts(kept, "LINKID", "date")


def gold_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = silver(raw_by_user(spark, sf_dir)).withColumnsRenamed({"linkid": "LINKID", "datetime": "DATETIME_5MIN"})
    return _plain(conform_gold(old))


def gold_five_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_by_type(spark, sf_dir)
    base = scratch_path(spark, "gold")
    write_days(gold, base)
    return _plain(five_channels(read_days(spark, base, *first_last_day(gold), schema=gold.schema)))


def mixed_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling in turn, then zones, nanoseconds and short fields, then text that is no time."""
    spellings = (
        "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyyMMddHHmmss", "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "yyyy-MM-dd'T'HH:mm:ss'.000000000'",
        "yyyy-M-d H:mm:ss", "yyyyMMddHHmm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "MM/dd/yyyy",
    )
    form = F.pmod("event_id", F.lit(len(spellings) + 1))
    text = F.lit("not a time")
    for i, spelling in enumerate(spellings):
        text = F.when(form == i, F.concat(F.lit(" "), F.date_format("ts", spelling), F.lit(" "))).otherwise(text)
    return _plain(table(spark, sf_dir, "events").select("event_id", parse_mixed_ts(text).alias("datetime")))


def file_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, kind = F.date_format("ts", "yyyyMMdd"), F.col("event_type")
    name = (
        F.when(kind == "click", F.concat(day, F.lit("_5Min.zip")))
        .when(kind == "view", F.concat(day, F.lit(".zip")))
        .when(kind == "error", F.lit("latest.zip"))
        .otherwise(F.concat(day, F.lit("7_5Min.zip")))
    )
    path = F.concat(F.lit("http://files.example/2024/"), name)
    return row_counts(table(spark, sf_dir, "events").select(day_from_path(path).alias("date")), "date")


def trailing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("date"), (F.dayofmonth("ts") - 2).alias("days")
    ).distinct()
    first, last = trailing_range("date", F.col("days"))
    return days.select("date", "days", first.alias("first_day"), last.alias("last_day"))


# -- series --------------------------------------------------------------------------------------


def dedupe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("linkid"), F.date_trunc("minute", "ts").alias("datetime"), F.col("value").alias(VALUE)
    )
    return _plain(dedupe_mean(minutes, ["linkid", "datetime"], [VALUE]))


def dedupe_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(dedupe_mean(price_series(spark, sf_dir), ["linkid", "datetime"], [VALUE]))


def grid_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(complete_grid(gold_by_type(spark, sf_dir), [VALUE]))


def grid_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(complete_grid(price_series(spark, sf_dir), [VALUE], step="1 day"))


def rolling_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(impute_rolling(complete_grid(gold_by_type(spark, sf_dir), [VALUE]), [VALUE]))


def rolling_fill_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = complete_grid(price_series(spark, sf_dir), [VALUE], step="1 day")
    return _plain(impute_rolling(grid, [VALUE], width="7 days"))


def seasonal_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seasonal stage alone, on the unfilled grid."""
    return _plain(impute_seasonal(complete_grid(gold_by_type(spark, sf_dir), [VALUE]), [VALUE]))


def full_imputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(impute(gold_by_type(spark, sf_dir), [VALUE]))


def full_imputation_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five channels, each filled on its own."""
    wide = five_channels(gold_by_type(spark, sf_dir))
    channels = [c for c in wide.columns if c.endswith("_mean")]
    return _plain(impute(wide, channels))


# -- split, scale, windows -----------------------------------------------------------------------


def moments_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of each link over the seven days up to every day."""
    moments = trailing_moments(daily_moments(gold_by_type(spark, sf_dir), [VALUE]), [VALUE], days=7)
    return moments.select(
        "linkid", F.date_format("day", "yyyyMMdd").alias("day"), F.col(f"{VALUE}_n").alias("n"), F.round(f"{VALUE}_mean", 6).alias("mean"),
        F.round(deviation(VALUE), 6).alias("sd"),
    )


def threshold_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower quartile over the seven days up to every day, by one sketch per day."""
    gold = materialise(gold_by_type(spark, sf_dir), "gold")
    found = trailing_percentiles(gold, materialise(daily_sketches(gold, VALUE), "sketches"), 25.0, VALUE, days=7)
    return found.select(F.date_format("day", "yyyyMMdd").alias("day"), "n", F.round("percentile", 6).alias("threshold"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(time_span(price_series(spark, sf_dir), "linkid"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(to_bronze(raw_by_user(spark, sf_dir)), "date", "ROADINSTTCD")


def _split(spark: SparkSession, sf_dir: str, cfg: TrainConfig) -> DataFrame:
    series = prepare_series(gold_by_type(spark, sf_dir), cfg)
    split = split_by_time(series, cfg.val_days, cfg.train_frac)
    side = F.when(split.in_train, "train").otherwise("validation")
    return _plain(series.select("linkid", "datetime", side.alias("side")))


def split_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, DAYS_CONFIG)


def split_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, FRACTION_CONFIG)


def split_fraction_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric keys, which are compared as text at every size."""
    prices = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("linkid"), F.col("l_shipdate").cast("timestamp").alias("datetime")
    ).distinct()
    split = split_by_time(prices, val_days=10_000, small=1)
    side = F.when(split.in_train, "train").otherwise("validation")
    return _plain(prices.select("linkid", "datetime", side.alias("side")))


def links_in_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows of the links that also occur in train."""
    rows = silver(raw_by_user(spark, sf_dir))
    split = split_by_time(rows, val_days=28)
    return _plain(restrict_links(split.validation(rows), split.train(rows)))


def _training(spark: SparkSession, sf_dir: str, cfg: TrainConfig = DAYS_CONFIG) -> TrainingSet:
    return training_set(prepare_series(gold_by_type(spark, sf_dir), cfg), cfg)


def scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = prepare_series(gold_by_type(spark, sf_dir), DAYS_CONFIG)
    split = split_by_time(series, DAYS_CONFIG.val_days)
    first, last = split.train(series).agg(F.min(F.unix_micros("datetime")), F.max(F.unix_micros("datetime"))).first()
    return _plain(fit_scaler(series, [VALUE], (first, last)))


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = prepare_series(gold_by_type(spark, sf_dir), DAYS_CONFIG)
    split = split_by_time(series, DAYS_CONFIG.val_days)
    first, last = split.train(series).agg(F.min(F.unix_micros("datetime")), F.max(F.unix_micros("datetime"))).first()
    return _plain(standardise(series, fit_scaler(series, [VALUE], (first, last)), [VALUE]))


def horizon_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written first, as the operator reads its input twice (chunk heads and rows).
    grid = materialise(complete_grid(gold_by_type(spark, sf_dir), [VALUE]), "grid")
    return _plain(add_target(grid, VALUE, horizon=3))


def _summary(sequences: DataFrame) -> DataFrame:
    """Scalars of each window of five channels."""
    values = F.transform("x", lambda step: step[2].cast("double"))
    return sequences.select(
        "linkid", "end_time", F.size("x").alias("length"), F.size(F.col("x")[0]).alias("width"),
        values[0].alias("first_z"), F.element_at(values, -1).alias("last_z"),
        F.aggregate(values, F.lit(0.0), lambda a, b: a + b).alias("sum_z"), "y", "train", "validation",
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_summary(expand_channels(_training(spark, sf_dir).sequences)), 4)


def sequences_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_summary(expand_channels(_training(spark, sf_dir, FRACTION_CONFIG).sequences)), 4)


CHANNELS_CONFIG = TrainConfig(val_days=7, channels=CHANNELS)


def imputed_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five different measures, each filled on its own."""
    return _plain(impute(channels_by_type(spark, sf_dir), list(CHANNELS)))


def sequences_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of five different measures; per channel the first and last value and a sum weighted by position."""
    data = training_set(prepare_series(channels_by_type(spark, sf_dir), CHANNELS_CONFIG), CHANNELS_CONFIG)
    scalars = []
    for i, name in enumerate(CHANNELS):
        values = channel_values(data.sequences, i).cast("array<double>")
        weighted = F.transform(values, lambda z, at: z * (at + 1))
        scalars += [
            values[0].alias(f"first_{name}"), F.element_at(values, -1).alias(f"last_{name}"),
            F.aggregate(weighted, F.lit(0.0), lambda a, b: a + b).alias(f"sum_{name}"),
        ]
    return _plain(data.sequences.select("linkid", "end_time", F.size("x").alias("length"), *scalars, "y", "train", "validation"), 3)


def target_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _training(spark, sf_dir)
    return _plain(data.train.agg(F.count("y").alias("samples")).withColumn("threshold", F.lit(data.threshold)), 4)


def shuffled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _training(spark, sf_dir)
    return _plain(shuffle_samples(data.train).select("linkid", "end_time", "y"), 4)


def epoch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three epochs: the places that the training windows take."""
    data = _training(spark, sf_dir)
    epochs = [
        epoch_order(data.store, data.fit_range, epoch=e, values=False).withColumn("epoch", F.lit(e)) for e in range(3)
    ]
    return reduce(DataFrame.unionByName, epochs).groupBy("epoch").agg(
        F.count("place").alias("samples"), F.count_distinct("place").alias("places"), F.min("place").alias("lowest"),
        F.max("place").alias("highest"), F.sum("place").alias("total"), F.count_distinct("batch").alias("batches"),
    )


# -- evaluation ----------------------------------------------------------------------------------


def eval_persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _training(spark, sf_dir)
    return _plain(evaluate(persistence(expand_channels(data.validation)), data.threshold), 4)


def eval_seasonal_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _training(spark, sf_dir)
    guess = seasonal_naive(data.validation, data.series, data.scaler, data.fit_range)
    return _plain(evaluate(guess, data.threshold), 4)


def forecast_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the fit and of the last value on both sides; has no SQL, as the fit is iterative."""
    data = _training(spark, sf_dir)
    return train_and_score(data, DAYS_CONFIG)[1]


def fit_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the metrics table of a fit says of each round.

    Round 0 is the last value, so its error is known; of the others only the laws are: finite errors, and a best error
    that never rises and is the lowest so far.
    """
    data = _training(spark, sf_dir)
    fitted = fit_steps(data.store, data.fit_range, data.val_range, data.threshold, rounds=7, patience=None)
    metrics = metrics_table(fitted.frame(spark), "run")
    steps = metrics.groupBy("step").pivot("name", ["train_mae", "val_mae", "best"]).agg(F.first("value"))
    in_order = Window.orderBy("step")  # a row for each round
    lowest = F.min("val_mae").over(in_order)
    start = F.first("val_mae").over(in_order)
    return _plain(steps.select(
        "step", (is_finite("train_mae") & is_finite("val_mae")).alias("finite"), (F.col("best") == lowest).alias("falls"),
        start.alias("start_mae"), F.lit(data.train_samples).cast("bigint").alias("train_samples"),
        F.lit(data.val_samples).cast("bigint").alias("val_samples"),
    ), 4)


def _daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means per day as if they were metrics per step."""
    return table(spark, sf_dir, "events").groupBy(F.dayofmonth("ts").alias("step")).agg(
        F.avg("value").alias("val_mae"), F.max("value").alias("train_mae")
    )


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(metrics_table(_daily_metrics(spark, sf_dir), "run"))


def lowest_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(best_step(metrics_table(_daily_metrics(spark, sf_dir), "run")))


def day_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores per side after the whole run; SQL knows only the counts of the fitted model."""
    raw = raw_by_type(spark, sf_dir)
    first, last = first_last_day(raw)
    lake = LakeConfig(archives=zip_archives(raw), base=scratch_path(spark, "lake"), links=None)
    scores = run_range(spark, lake, TrainConfig(val_days=7), first, last).scores
    mae = F.when(F.col("model") == "persistence", F.col("mae")).alias("mae")
    return _plain(scores.select("model", "side", "n", (F.col("tp") + F.col("fn")).alias("positives"), mae), 4)


def _files_lake(spark: SparkSession, sf_dir: str) -> tuple[LakeConfig, DataFrame]:
    """An empty lake, and the readings with the name of the file they lie in: three for each day."""
    raw = raw_by_type(spark, sf_dir).withColumn("file", F.pmod(F.xxhash64("CREATHM", "PASNGSPED"), F.lit(3)))
    return LakeConfig(archives="", base=scratch_path(spark, "lake"), links=None, versioned=True), raw


def silver_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after one file of each day came late and another was corrected: updates of those files alone."""
    cfg, raw = _files_lake(spark, sf_dir)
    late, wrong = F.col("file") == 0, F.col("file") == 1
    speed = F.col("PASNGSPED").cast("double")
    days = first_last_day(raw)
    csv_files(raw.filter(~late).withColumn("PASNGSPED", F.when(wrong, speed + 7).otherwise(speed).cast("string")), cfg.zone("raw"))
    refresh_silver(spark, cfg)
    csv_files(raw.filter(wrong), cfg.zone("raw"))
    refresh_silver(spark, cfg)
    csv_files(raw.filter(late), cfg.zone("raw"))
    refresh_silver(spark, cfg)
    return _plain(zone_rows(spark, cfg, "silver", *days))


def slots_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from a stream over the files: what has landed, then what lands late."""
    cfg, raw = _files_lake(spark, sf_dir)
    days, checkpoint = first_last_day(raw), scratch_path(spark, "stream")
    for part in (raw.filter("file > 0"), raw.filter("file = 0")):
        csv_files(part, cfg.zone("raw"))
        stream_slots(spark, cfg, checkpoint, files_per_batch=40).awaitTermination()
    return _plain(zone_rows(spark, cfg, "silver", *days))


def _planned(spark: SparkSession, sf_dir: str) -> tuple[LakeConfig, str, str]:
    """A lake whose zones were filled by the plans, and its days."""
    raw = dirty_readings(spark, sf_dir)
    cfg = LakeConfig(archives="", base=scratch_path(spark, "lake"), links=None)
    csv_lake(raw, cfg.zone("raw"))
    days = first_last_day(raw)
    raw_to_bronze(spark, cfg, *days)
    bronze_to_silver(spark, cfg, *days)
    silver_to_gold(spark, cfg, *days)
    return cfg, *days


def bronze_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, *days = _planned(spark, sf_dir)
    return _plain(read_days(spark, cfg.zone("bronze"), *days, BRONZE_SCHEMA))


def silver_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, *days = _planned(spark, sf_dir)
    return _plain(read_days(spark, cfg.zone("silver"), *days, SILVER_SCHEMA))


def gold_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, *days = _planned(spark, sf_dir)
    return _plain(gold_rows(spark, cfg, *days))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_slot_mean": silver_slot_mean,
    "csv_scan_days": csv_scan_days,
    "bronze_cast": bronze_cast,
    "filter_links": link_filter,
    "gold_conform": gold_conform,
    "gold_five_channels": gold_five_channels,
    "gold_replace_days": gold_replace_days,
    "gold_snapshot": gold_snapshot,
    "pending_days": pending,
    "lake_roundtrip": lake_roundtrip,
    "file_events_json": file_events_json,
    "zip_members": zip_members,
    "land_zip": zip_landing,
    "bronze_plan": bronze_plan,
    "silver_plan": silver_plan,
    "gold_plan": gold_plan,
    "silver_delta": silver_delta,
    "stream_slots": slots_stream,
    "parse_mixed_ts": mixed_stamps,
    "day_from_path": file_days,
    "trailing_range": trailing_ranges,
    "row_counts": counts,
    "time_span": spans,
    "dedupe_mean": dedupe_events,
    "dedupe_mean_days": dedupe_prices,
    "complete_grid": grid_minutes,
    "complete_grid_days": grid_days,
    "impute_rolling": rolling_fill,
    "impute_rolling_days": rolling_fill_days,
    "impute_seasonal": seasonal_fill,
    "impute": full_imputation,
    "impute_channels": full_imputation_channels,
    "split_days": split_days,
    "split_fraction": split_fraction,
    "split_fraction_numeric": split_fraction_numeric,
    "restrict_links": links_in_train,
    "scaler": scaler,
    "standardise": scaled,
    "horizon_target": horizon_target,
    "sequences": sequences,
    "sequences_fraction": sequences_fraction,
    "impute_measures": imputed_channels,
    "sequences_channels": sequences_channels,
    "target_threshold": target_cut,
    "trailing_moments": moments_of_days,
    "trailing_threshold": threshold_of_days,
    "shuffle_samples": shuffled_samples,
    "epoch_order": epoch_orders,
    "eval_persistence": eval_persistence,
    "eval_seasonal_naive": eval_seasonal_naive,
    "forecast_eval": forecast_eval,
    "fit_steps": fit_rounds,
    "metrics_long": metrics_long,
    "best_step": lowest_step,
    "day_run": day_run,
}
