from roadspeed.operators.consensus import FittedSteps, LinearForecast, fit_steps
from roadspeed.operators.epochs import epoch_order, permuted
from roadspeed.operators.evaluate import best_step, evaluate
from roadspeed.operators.forecast import fit_forecast, forecast, persistence, seasonal_naive
from roadspeed.operators.gold import conform_gold, five_channels
from roadspeed.operators.grid import complete_grid, dedupe_mean
from roadspeed.operators.impute import impute, impute_rolling, impute_seasonal
from roadspeed.operators.percentile import exact_percentile, target_threshold
from roadspeed.operators.readings import filter_links, normalise_time, same_day, slot_mean, to_bronze, valid_stamp
from roadspeed.operators.scale import fit_scaler, standardise
from roadspeed.operators.sequences import (
    WindowStore, add_target, build_sequences, expand_channels, shuffle_samples, window_store,
)
from roadspeed.operators.split import Split, restrict_links, row_counts, split_by_time, time_span

__all__ = [
    "FittedSteps", "LinearForecast", "Split", "WindowStore", "add_target", "best_step", "build_sequences", "complete_grid", "conform_gold", "dedupe_mean",
    "epoch_order", "evaluate", "exact_percentile", "expand_channels", "filter_links", "fit_forecast", "fit_scaler", "fit_steps",
    "five_channels", "forecast", "impute", "impute_rolling", "impute_seasonal", "normalise_time",
    "permuted", "persistence", "restrict_links", "row_counts", "same_day", "seasonal_naive", "shuffle_samples",
    "slot_mean", "split_by_time", "standardise", "target_threshold", "time_span", "to_bronze", "valid_stamp",
    "window_store",
]
