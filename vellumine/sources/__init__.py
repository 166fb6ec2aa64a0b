"""Readers, sinks and pluggable providers."""

from vellumine.sources.tables import settled, shared_dir, ship, sweep, table

__all__ = ["settled", "shared_dir", "ship", "sweep", "table"]
