"""Configuration documents."""

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def resized_document(
    content: Column, job_id: Column, job_name: Column, driver_size: Column, worker_size: Column, num_workers: Column
) -> Column:
    """Struct (action, content): the job's document with the suggested cluster.

    Arrow-batched Python, one row per job: editing must keep unknown keys, their order and their number format, which
    the built-in JSON functions do not.
    """

    def edit(content: pd.Series, job_id: pd.Series, job_name: pd.Series, cluster: pd.DataFrame) -> pd.DataFrame:
        def document(text, job, name, driver, worker, workers):
            size = {"driver_node_type_id": driver, "node_type_id": worker, "num_workers": workers}
            try:
                existing = json.loads(text)
            except (TypeError, ValueError):
                existing = None
            if isinstance(existing, dict) and isinstance(existing.get("cluster_config", size), dict):
                existing.setdefault("cluster_config", size)["num_workers"] = workers
                return "update", json.dumps(existing, indent=2)
            return "create", json.dumps({"job_id": job, "job_name": name, "cluster_config": size}, indent=2)

        rows = [
            document(text, int(job), name, driver, worker, int(workers))
            for text, job, name, driver, worker, workers in zip(
                content, job_id, job_name, cluster["driver_size"], cluster["worker_size"], cluster["num_workers"]
            )
        ]
        return pd.DataFrame(rows, columns=["action", "content"])

    cluster = F.struct(
        driver_size.alias("driver_size"), worker_size.alias("worker_size"), num_workers.alias("num_workers")
    )
    return F.pandas_udf(edit, "action string, content string")(content, job_id, job_name, cluster)
