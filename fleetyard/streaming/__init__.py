"""Structured Streaming forms of the incremental reports."""
from fleetyard.streaming.yard_state import current_yard, in_yard, latest_event_per_asset, start

__all__ = ["current_yard", "in_yard", "latest_event_per_asset", "start"]
