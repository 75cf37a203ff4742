"""Layered lakehouse refinement on Spark: ingest, quality gate, quarantine, reports."""
