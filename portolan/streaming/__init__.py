"""Incremental loading of newly landed monthly files."""

from portolan.streaming.monthly import read_fact, read_file_months, read_load_log, start_monthly_load

__all__ = ["read_fact", "read_file_months", "read_load_log", "start_monthly_load"]
