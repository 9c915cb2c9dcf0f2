from roadspeed.plans.config import LakeConfig, TrainConfig
from roadspeed.plans.daily import DayResult, land_days, run_day, run_range
from roadspeed.plans.lake import bronze_to_silver, raw_to_bronze, silver_to_gold
from roadspeed.plans.training import TrainingSet, prepare_series, train_and_score, training_set

__all__ = [
    "DayResult", "LakeConfig", "TrainConfig", "TrainingSet", "bronze_to_silver", "land_days", "prepare_series",
    "raw_to_bronze", "run_day", "run_range", "silver_to_gold", "train_and_score", "training_set",
]
