"""Parameters of the registered queries (shared by the Spark side and the SQL oracle)."""

from __future__ import annotations

from clickpulse.plans.condition import Condition

# Run id written into the R1-R3 result rows.
TASK_ID = "task-fixture"

# Condition of the batch jobs on the fixture (dates fall inside the events).
COND = Condition(start_date="2024-01-05", end_date="2024-01-20", start_age=20, end_age=50,
                 target_page_flow="1,2,3,4,5,6,7")

# The same condition in the properties form.
COND_PROPERTIES = """
condition.params.json={startDate:"2024-01-05", endDate:"2024-01-20", startAge: "20", endAge: "50", \\
targetPageFlow:"1,2,3,4,5,6,7", professionals: "", city:"", gender:"", keywords:"", categoryIds:"" }
"""

# Blacklist: clicks per (day, user, ad) that flag a user; micro-batches are
# replayed as one-hour slices of event time.
BLACKLIST_THRESHOLD = 8
SLOT_MS = 3_600_000

# "now" of the last-hour trend: 2024-01-15 12:00 UTC.
LAST_HOUR_END_MS = 1_705_320_000_000
LAST_HOUR_SPAN_MS = 3_600_000
# the original 5 s batch interval: the last hour is 720 such slots
LAST_HOUR_SLOT_MS = 5_000
# the trend at every slide of that day
LAST_HOUR_DAY_MS = (1_705_276_800_000, 1_705_363_200_000)
# buckets of the tables saved by user
USER_BUCKETS = 8
