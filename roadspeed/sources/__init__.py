from roadspeed.sources.archives import list_members, read_zip_members
from roadspeed.sources.csv_days import read_raw_csv
from roadspeed.sources.days import (
    day_list, day_range, existing_days, landed_days, landed_files, pending_days, read_days,
)
from roadspeed.sources.gold_jdbc import day_predicates, read_gold

__all__ = [
    "day_list", "day_predicates", "day_range", "existing_days", "landed_days", "landed_files", "list_members",
    "pending_days", "read_days", "read_gold", "read_raw_csv", "read_zip_members",
]
