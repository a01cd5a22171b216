"""Reusable DataFrame operators.

keyed   -- latest_by, latest_then, priority_dedupe, text_lookup (top-1 per key)
status  -- status roll-ups: per object (user_status) or next to rows (with_statuses)
joins   -- semi / anti restriction, size-checked catalogue broadcast, spread_key,
           salted_join
"""
