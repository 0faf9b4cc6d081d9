"""Whole jobs: reports, KPIs, the hourly load."""
