"""Page-to-page conversion along a target page flow
(F6-F8, W5, A4, A5, J5, C2, C3, C6, C8).

Transitions are consecutive actions of a session ordered by ``action_time``
after pages outside the target list are removed (so 1 -> 9 -> 2 counts as
``1->2``). A session is not sorted as one unit: one shuffle range-partitions the
actions by (session, time) into balanced slices, however long a session is. Each
slice, sorted, counts its pages and its pairs of neighbouring actions in one pass
over Arrow batches and hands on those counts (at most one row per pair of target
pages) and its first and last action. A pair that joins two slices comes from the
last action of one and the first of the next, two rows per slice.
"""

from __future__ import annotations

import sys
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.text import flow, java_split, percent, ratio, target_flows

# the slice function is shipped by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = ("slice int, from_page long, to_page long, n long, first_session string, first_page long, "
         "last_session string, last_page long")


def target_pages(page_flow: str) -> list[str]:
    return java_split(page_flow, ",")


def _on_pages(visits: DataFrame, pages: list[str]) -> DataFrame:
    """keep actions whose page id, as text, is in ``pages``."""
    return visits.where(F.col("page_id").cast("string").isin(pages))


def page_denominator(visits: DataFrame, page_flow: str) -> DataFrame:
    """A4: actions per target page except the last one."""
    pages = target_pages(page_flow)
    return (_on_pages(visits, pages[:-1]).groupBy("page_id")
            .agg(F.count(F.lit(1)).alias("page_count")))


def _count_slice(batches):
    """Counts of one sorted slice: pages (to_page null), pairs, and its first and last action."""
    pages, pairs, first, last = Counter(), Counter(), None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        session, page = batch.column(0), batch.column(1)
        for p in pc.value_counts(page).to_pylist():
            pages[p["values"]] += p["counts"]
        ends = (session[0].as_py(), page[0].as_py()), (session[-1].as_py(), page[-1].as_py())
        if first is None:
            first = ends[0]
        elif last[0] == ends[0][0] and last[0] is not None:
            pairs[last[1], ends[0][1]] += 1
        last = ends[1]
        if batch.num_rows > 1:
            same = pc.fill_null(pc.equal(session.slice(1), session.slice(0, len(session) - 1)), False)
            t = pa.table({"a": page.slice(0, len(page) - 1), "b": page.slice(1)}).filter(same)
            for r in t.group_by(["a", "b"]).aggregate([([], "count_all")]).to_pylist():
                pairs[r["a"], r["b"]] += r["count_all"]
    if first is None:
        return
    at = TaskContext.get().partitionId()
    none = (None,) * 4
    rows = [(at, a, b, n, *none) for (a, b), n in pairs.items()] \
        + [(at, p, None, n, *none) for p, n in pages.items()] + [(at, None, None, 0, *first, *last)]
    names = [c.split()[0] for c in SLICE.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in SLICE.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _slices(actions: DataFrame) -> DataFrame:
    """The slices' rows, the edges joined: (from_page, to_page, n); to_page null counts actions."""
    keys = ("session_id", "action_time", "page_id")
    ordered = actions.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = ordered.select("session_id", F.col("page_id").cast("long").alias("page_id")) \
        .mapInArrow(_count_slice, SLICE)
    # the slices' counts are summed; their edges, one per slice, meet in a sorted list,
    # where a slice is joined to the next one that holds rows
    summed = rows.groupBy("from_page", "to_page").agg(
        F.sum("n").cast("long").alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("n") == 0, F.struct(
            "slice", "first_session", "first_page", "last_session", "last_page")))).alias("edges"))
    edge = lambda i: F.element_at("edges", i)
    pair = lambda i: F.when(edge(i)["last_session"] == edge(i + 1)["first_session"], F.struct(
        edge(i)["last_page"].alias("from_page"), edge(i + 1)["first_page"].alias("to_page"),
        F.lit(1).cast("long").alias("n")))
    own = F.array(F.struct("from_page", "to_page", "n"))
    joined = F.when(F.size("edges") > 1, F.filter(
        F.transform(F.sequence(F.lit(1), F.size("edges") - 1), pair), lambda x: x.isNotNull()))
    return summed.select(F.inline(F.concat(own, F.coalesce(joined, F.array().cast(
        "array<struct<from_page:bigint,to_page:bigint,n:bigint>>"))))).where(F.col("n") > 0)


def consecutive_pairs(actions: DataFrame) -> DataFrame:
    """(from_page, to_page, n): how often each page follows each in a session.

    ``actions`` has session_id, action_time (sortable text), page_id. Order is
    action_time, then page_id for equal times.
    """
    return (_slices(actions).where(F.col("to_page").isNotNull()).groupBy("from_page", "to_page")
            .agg(F.sum("n").cast("long").alias("n")))


def page_transitions(visits: DataFrame, page_flow: str) -> DataFrame:
    """F6 + W5 + F8 + A5: count of each target transition that occurs."""
    pages = target_pages(page_flow)
    flows = consecutive_pairs(_on_pages(visits, pages)).select(
        flow(F.col("from_page"), F.col("to_page")).alias("flow"), "from_page", F.col("n").alias("flow_count"))
    return flows.where(F.col("flow").isin(target_flows(pages)))


def page_conversion(visits: DataFrame, page_flow: str, task_id: str) -> DataFrame:
    """J5 + C8 + C6: ``rate`` = transitions a->b / actions on a, as ``.00%`` text.

    Numerators and denominators come from the same slices; the rows after them
    are pairs of target pages. Transitions that never occur are absent, as in the
    original job.
    """
    pages = target_pages(page_flow)
    step = flow(F.col("from_page"), F.col("to_page"))
    counted = (_slices(_on_pages(visits, pages))
               .select("from_page", F.when(F.col("to_page").isNotNull(), step).alias("flow"), "n")
               .where(F.col("flow").isNull() | F.col("flow").isin(target_flows(pages)))
               .groupBy("from_page", "flow").agg(F.sum("n").cast("long").alias("n")))
    counts_for_rate = F.col("flow").isNull() & F.col("from_page").cast("string").isin(pages[:-1])
    per_page = Window.partitionBy("from_page")
    out = (counted.withColumn("page_count", F.sum(F.when(counts_for_rate, F.col("n"))).over(per_page))
           .where(F.col("flow").isNotNull()))
    return out.select(F.lit(task_id).alias("task_id"), "flow",
                      percent(ratio(F.col("n"), F.col("page_count")), leading_zero=False).alias("rate"))
