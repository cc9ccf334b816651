"""End-to-end batch jobs: parameters -> operators -> result sink.

A ``Sink`` is any ``(name, DataFrame) -> None``: ``parquet_sink`` writes under a
folder, ``jdbc_sink`` appends to database tables (executors write in parallel).
Each run gets one task id (a uuid made once on the driver).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickpulse.operators import area as A
from clickpulse.operators import jumps as J
from clickpulse.operators import visits as V
from clickpulse.sinks.jdbc import jdbc_append

Sink = Callable[[str, DataFrame], None]


@dataclass
class Conditions:
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | str | None = None
    end_age: int | str | None = None
    target_page_flow: str = "1,2,3,4,5,6,7"

    @classmethod
    def from_row(cls, row) -> Conditions:
        """From a parsed parameter row (``sources.params.parse_conditions``)."""
        d = row.asDict()
        return cls(d.get("startDate"), d.get("endDate"), d.get("startAge"), d.get("endAge"),
                   d.get("targetPageFlow") or "1,2,3,4,5,6,7")


def parquet_sink(root: str) -> Sink:
    def write(name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(os.path.join(root, name))

    return write


def jdbc_sink(url: str, properties: dict[str, str] | None = None, batchsize: int = 1000) -> Sink:
    def write(name: str, df: DataFrame) -> None:
        jdbc_append(df, url, name, properties, batchsize)

    return write


def category_jobs(visits: DataFrame, users: DataFrame, cond: Conditions, sink: Sink | None = None,
                  task_id: str | None = None, top_n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Q1 + Q2 on the filtered visits. Returns (category_top10, category_session_top10)."""
    task_id = task_id or str(uuid.uuid4())
    fv = V.visit_filter(visits, users, cond.start_date, cond.end_date, cond.start_age, cond.end_age)
    top = V.category_top_n(fv, top_n, task_id)
    # The top list is at most top_n rows: materialise it once so Q2 does not recompute Q1.
    spark = visits.sparkSession
    top = spark.createDataFrame(top.collect(), top.schema)
    sessions = V.category_session_top_n(fv, top, top_n, task_id)
    if sink:
        sink("category_top10", top)
        sink("category_session_top10", sessions)
    return top, sessions


def jump_job(visits: DataFrame, cond: Conditions, sink: Sink | None = None, task_id: str | None = None) -> DataFrame:
    """Q3 over all visits (the reference ignores the date/age conditions here)."""
    out = J.page_jump_ratio(visits, cond.target_page_flow, task_id or str(uuid.uuid4()))
    if sink:
        sink("jump_page_ratio", out)
    return out


def area_job(visits: DataFrame, cities: DataFrame, products: DataFrame, sink: Sink | None = None,
             task_id: str | None = None, top_n: int = 3) -> DataFrame:
    """Q4 over all visits."""
    out = A.area_product_top_n(visits, cities, products, top_n, task_id or str(uuid.uuid4()))
    if sink:
        sink("area_count_info", out)
    return out
