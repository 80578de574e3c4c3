"""Cleaning pipelines, reports and chart summaries."""
