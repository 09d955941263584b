"""Whole jobs: loading the warehouse, the reports, and training."""
