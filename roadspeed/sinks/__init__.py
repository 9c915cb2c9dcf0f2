from roadspeed.sinks.days import WriteReport, write_days
from roadspeed.sinks.gold_jdbc import replace_days_jdbc
from roadspeed.sinks.land import land_zip
from roadspeed.sinks.runs import metrics_table, params_table, write_run

__all__ = [
    "WriteReport", "land_zip", "metrics_table", "params_table", "replace_days_jdbc", "write_days", "write_run",
]
