"""Incremental maintenance of the visit table with Structured Streaming."""

from touchline.streaming.incremental_visits import start_visit_maintenance

__all__ = ["start_visit_maintenance"]
