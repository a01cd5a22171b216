"""Parameters of the registered (checked and benchmarked) queries.

The registered queries run in full-load mode over the whole derived tables:
the rolling windows span ``FULL_WINDOW`` days back from ``AS_OF`` (the
initial-load setting of the source jobs), which covers every date in the
test data. ``AS_OF`` is fixed so results are repeatable.
"""

AS_OF = "2030-01-01"
FULL_WINDOW = 3650
SLICE_DAYS = 45
# Slices of the checked run by slices: each is a job of its own.
WIDE_SLICE_DAYS = 900
# The earlier day of the query that keeps winners up to date.
EARLIER_DAY = "2025-06-01"

# Defaults of the scheduled jobs (rolling, incremental windows).
JOB_DEFAULTS = {
    "purchasing_tracker": {"ini": 30, "fim": 0},
    "po_approvals": {"ini": None},
    "po_payment": {"ini": 90},
    "parts_history": {"ini": 365, "fim": 0, "slice_days": SLICE_DAYS},
}

# A window that cuts off dates at both ends of the test data (days back from AS_OF).
CUT_WINDOW = (1500, 700)

# Purchasing groups of the legacy buyer filter, some of those in the test data.
PAYMENT_GROUPS = ("200", "203")
