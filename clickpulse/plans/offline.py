"""The batch application: R1 -> R2 -> R3 on the filtered visits, R4 on all visits.

``offline_results`` only builds the four result DataFrames; ``run_offline``
writes them through a sink (a catalog table, JDBC, ...). The visits that pass
the condition feed three jobs; with ``materialize=True`` only the six columns
those jobs read are written once as Parquet into the shared
``spark.checkpoint.dir`` -- reliable storage that cuts the lineage, so a lost
executor does not send R2 and R3 back to the raw scan and the join, and each job
reads just its columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickpulse.operators import area, category, conversion
from clickpulse.plans.condition import Condition, filter_visits
from clickpulse.session import materialized

# Result tables of the original jobs (the R4 name fixed from its typo).
TABLE_NAMES = {
    "category_top10": "category_top10",
    "category_session_top10": "category_top10_session_count",
    "page_conversion": "page_conversion_rate",
    "area_product_top3": "area_product_click",
}
# How the application writes each result: R1 and R2 refill their table, R3 adds
# to its history, R4 replaces its table.
WRITE_MODES = {
    "category_top10": "truncate_insert",
    "category_session_top10": "truncate_insert",
    "page_conversion": "append",
    "area_product_top3": "overwrite",
}
_SHARED_COLS = ["session_id", "action_time", "page_id", "click_category_id",
                "order_category_ids", "pay_category_ids"]


@dataclass
class OfflineResults:
    """The four batch results, lazily built."""

    category_top10: DataFrame
    category_session_top10: DataFrame
    page_conversion: DataFrame
    area_product_top3: DataFrame

    def items(self):
        return [("category_top10", self.category_top10),
                ("category_session_top10", self.category_session_top10),
                ("page_conversion", self.page_conversion),
                ("area_product_top3", self.area_product_top3)]


def offline_results(tables, cond: Condition, task_id: str, materialize: bool = False) -> OfflineResults:
    """``tables`` offers visits(), users(), cities(), products() (fixture or catalog)."""
    filtered = filter_visits(tables.visits(*cond.ts_bounds()), tables.users(), cond).select(*_SHARED_COLS)
    if materialize:
        filtered = materialized(filtered, "offline")
    top10, sessions = category.top_category_sessions(filtered, task_id)
    return OfflineResults(
        category_top10=top10,
        category_session_top10=sessions,
        page_conversion=conversion.page_conversion(filtered, cond.target_page_flow or "", task_id),
        # R4 reads the whole clickstream: the condition does not apply to it
        area_product_top3=area.area_product_top3(tables.visits(), tables.cities(), tables.products()),
    )


def run_offline(tables, cond: Condition, task_id: str, sink: Callable[[DataFrame, str, str], None],
                names: dict[str, str] | None = None, materialize: bool = True) -> OfflineResults:
    """Run the four jobs and hand each result to ``sink(df, table_name, write_mode)``."""
    names = {**TABLE_NAMES, **(names or {})}
    res = offline_results(tables, cond, task_id, materialize)
    for key, df in res.items():
        sink(df, names[key], WRITE_MODES[key])
    return res
