"""Job parameters (S13) and the condition filter on visits."""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed value of the parameter-file format: the properties key holding the JSON.
PARAMS_KEY = "condition.params.json"


def _is_date(text: str) -> bool:
    try:
        dt.date.fromisoformat(text)
        return True
    except ValueError:
        return False


def is_set(s: str | None) -> bool:
    """a text parameter counts only when not null and not empty."""
    return s is not None and len(s) > 0


@dataclass(frozen=True)
class Condition:
    """Filter parameters of the batch jobs.

    Only the date and age bounds filter (F1). ``professionals``, ``city``,
    ``gender``, ``keywords`` and ``category_ids`` are accepted and carried
    but never applied (F3), as in the original jobs.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int = 0
    end_age: int = 0
    professionals: str | None = None
    city: str | None = None
    gender: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str | None = None

    # camelCase keys of the JSON parameter file -> field names
    _ALIASES = {
        "startDate": "start_date", "endDate": "end_date", "startAge": "start_age",
        "endAge": "end_age", "categoryIds": "category_ids", "targetPageFlow": "target_page_flow",
    }

    @classmethod
    def from_dict(cls, params: dict) -> "Condition":
        names = {f.name for f in fields(cls)}
        kw = {}
        for key, value in params.items():
            name = cls._ALIASES.get(key, key)
            if name not in names:
                continue
            if name in ("start_age", "end_age"):
                # ages arrive as text in the parameter file
                value = int(value) if is_set(str(value) if value is not None else None) else 0
            kw[name] = value
        return cls(**kw)

    @classmethod
    def from_json(cls, text: str) -> "Condition":
        """Strict JSON, or the lenient form with bare keys (``{startDate:"..."}``)."""
        try:
            return cls.from_dict(json.loads(text))
        except json.JSONDecodeError:
            quoted = re.sub(r'([{,]\s*)([A-Za-z_][A-Za-z0-9_]*)\s*:', r'\1"\2":', text)
            return cls.from_dict(json.loads(quoted))

    @classmethod
    def from_properties(cls, text: str, key: str = PARAMS_KEY) -> "Condition":
        """The ``key=<json>`` entry of a properties file (``\\`` continues a line)."""
        joined = re.sub(r"\\\r?\n\s*", "", text)
        for line in joined.splitlines():
            line = line.strip()
            if line.startswith(key) and "=" in line:
                return cls.from_json(line.split("=", 1)[1].strip())
        raise KeyError(key)

    def ts_bounds(self) -> tuple[str | None, str | None]:
        """The date bounds as ISO dates for a source that filters raw timestamps.

        A bound that is not a plain ``yyyy-MM-dd`` date is left out: the text
        comparison of :meth:`date_predicate` decides alone.
        """
        iso = [d if is_set(d) and re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", d) and _is_date(d) else None
               for d in (self.start_date, self.end_date)]
        return iso[0], iso[1]

    def date_predicate(self, date_col: Column) -> Column:
        """F1, date part: ``yyyy-MM-dd`` text bounds, inclusive, each only if set."""
        preds = []
        if is_set(self.start_date):
            preds.append(date_col >= F.lit(self.start_date))
        if is_set(self.end_date):
            preds.append(date_col <= F.lit(self.end_date))
        return _all(preds)

    def age_predicate(self, age_col: Column) -> Column:
        """F1, age part: inclusive bounds, each only when > 0."""
        preds = []
        if self.start_age > 0:
            preds.append(age_col >= F.lit(self.start_age))
        if self.end_age > 0:
            preds.append(age_col <= F.lit(self.end_age))
        return _all(preds)


def _all(preds: list[Column]) -> Column:
    out = F.lit(True)
    for p in preds:
        out = out & p
    return out


def filter_visits(visits: DataFrame, users: DataFrame, cond: Condition) -> DataFrame:
    """J1 + F1: visits joined to their user, kept when the condition holds.

    Returns the visit columns only (``v.*``). An inner join, so a user id
    listed twice in ``users`` doubles its visits. The date bound sits on the
    visit side (pushed into the scan), the age bound on the user side, so the
    join only sees qualifying rows of both.
    """
    v = visits.where(cond.date_predicate(F.col("date")))
    u = users.where(cond.age_predicate(F.col("age"))).select("user_id")
    return v.join(u, "user_id").select(*visits.columns)
