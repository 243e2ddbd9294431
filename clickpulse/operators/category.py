"""Top categories by click/order/pay counts, then the top sessions
of each top category (F5, C1, C12, A1-A3, W2, W3, J4).

:func:`top_category_sessions` chains both; the separate functions serve callers
that need only one of them or bring their own category list.

All counting is one ``groupBy`` with conditional counts -- a partial hash
aggregate on every map task, so a hot category costs one row per task in the
shuffle. The global top 10 is a ``TakeOrderedAndProject`` (per-partition top
10, merged). The session counts keep only clicks of the top categories
(semi join with a 10-row side), aggregate per (category, session) and keep the
10 best sessions per category with ``row_number`` -- Spark adds a partial
WindowGroupLimit before the shuffle on the category, so a category with
millions of sessions ships at most 10 rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.text import id_text, split_ids

CLICK, ORDER, PAY = "click", "order", "pay"


def _kind_and_ids() -> tuple:
    click = F.col("click_category_id")
    order, pay = F.col("order_category_ids"), F.col("pay_category_ids")
    kind = (F.when(click != -1, F.lit(CLICK))
            .when(order.isNotNull(), F.lit(ORDER))
            .when(pay.isNotNull(), F.lit(PAY)))
    ids = (F.when(click != -1, F.array(id_text(click)))
           .when(order.isNotNull(), split_ids(order))
           .when(pay.isNotNull(), split_ids(pay)))
    return kind, ids


def classify_actions(visits: DataFrame) -> DataFrame:
    """``kind`` and category ``ids`` of each action; first match wins.

    click when ``click_category_id != -1``, else order when
    ``order_category_ids`` is not null, else pay when ``pay_category_ids`` is
    not null, else nothing (null kind, null ids).
    """
    kind, ids = _kind_and_ids()
    return visits.select("*", kind.alias("kind"), ids.alias("category_ids"))


def explode_ids(visits: DataFrame) -> DataFrame:
    """One row per (action, category id) with its kind.

    The id array is built inside the same projection as the ``explode``:
    exploding an array column produced by an earlier projection runs
    markedly slower.
    """
    kind, ids = _kind_and_ids()
    return visits.select("session_id", "action_time", kind.alias("kind"),
                         F.explode(ids).alias("category_id"))


def category_counts(visits: DataFrame) -> DataFrame:
    """A1 + A2: click, order and pay counts per category id (text); missing = 0."""
    kind, ids = _kind_and_ids()
    e = visits.select(kind.alias("kind"), F.explode(ids).alias("category_id"))
    return e.groupBy("category_id").agg(
        F.count_if(F.col("kind") == CLICK).cast("long").alias("click_count"),
        F.count_if(F.col("kind") == ORDER).cast("long").alias("order_count"),
        F.count_if(F.col("kind") == PAY).cast("long").alias("pay_count"),
    )


def category_top10(visits: DataFrame, task_id: str, n: int = 10) -> DataFrame:
    """The ``n`` categories with most clicks, then orders, then pays.

    Ties beyond the three counts go to the smaller category id (text order).
    """
    counts = category_counts(visits)
    top = counts.orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                         F.asc("category_id")).limit(n)
    return top.select(F.lit(task_id).alias("task_id"), "category_id",
                      "click_count", "order_count", "pay_count")


def category_session_counts(visits: DataFrame, top_categories: DataFrame) -> DataFrame:
    """J4 + A3: per (category, session), the actions whose click category is a top one.

    The test is on the text of ``click_category_id`` against the top list, as
    in the original job. ``top_categories`` has at most 10 rows (a ``limit``),
    so AQE broadcasts it; a longer list of a caller's own takes a shuffle join.
    """
    top_ids = top_categories.select("category_id").distinct()
    v = visits.select(id_text(F.col("click_category_id")).alias("category_id"), "session_id")
    kept = v.join(top_ids, "category_id", "left_semi")
    return kept.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))


def category_session_top10(visits: DataFrame, top_categories: DataFrame, task_id: str,
                           n: int = 10) -> DataFrame:
    """At most ``n`` sessions per category by count desc; ties by session id."""
    counts = category_session_counts(visits, top_categories)
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    top = counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return top.select(F.lit(task_id).alias("task_id"), "category_id", "session_id",
                      F.col("click_count").cast("long").alias("click_count"))


def top_category_session_counts(visits: DataFrame, task_id: str, n_categories: int = 10) -> DataFrame:
    """A3: actions per (top category, session), with R1's list computed from the same visits."""
    return category_session_counts(visits, category_top10(visits, task_id, n_categories))


def top_category_sessions(visits: DataFrame, task_id: str, n_categories: int = 10,
                          n_sessions: int = 10) -> tuple[DataFrame, DataFrame]:
    """(top categories, their top sessions).

    Two pruned scans: R1 shuffles one row per category and task; R2 meets its
    list of at most ``n_categories`` rows before anything is shuffled, so only
    actions of the top categories are counted per session.
    """
    top = category_top10(visits, task_id, n_categories)
    return top, category_session_top10(visits, top, task_id, n_sessions)
