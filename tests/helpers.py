"""Look-alike runs and plan access for the tests."""

import datetime as dt
import json


def config(workers, kind="small"):
    return json.dumps(
        {"cluster_config": {"driver_node_type_id": f"{kind}_driver", "node_type_id": kind, "num_workers": workers}}
    )


def run(job_id, minutes, day=1, output="INFO: fine", configuration=None, name=None, hour=0):
    start = dt.datetime(2024, 3, day, hour)
    end = start + dt.timedelta(minutes=minutes or 0)
    text = config(2) if configuration is None else configuration
    return (job_id, name or f"job {job_id}", text, None if minutes is None else float(minutes), start, end, output)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
