"""Validated load, audits, views, reports, fraud detectors and batch commands."""
