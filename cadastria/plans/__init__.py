"""Staging, star schema, marts, measures, reports, extracts and models."""
