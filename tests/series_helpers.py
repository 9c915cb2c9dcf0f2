from datetime import datetime, timedelta

START = datetime(2025, 11, 13)


def slots(n, start=START, step=timedelta(minutes=5)):
    return [start + i * step for i in range(n)]
