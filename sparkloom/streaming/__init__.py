"""Structured Streaming forms of page ingestion and step metrics."""

from .pages import crawl_progress, ingest_pages, windowed_events

__all__ = ["crawl_progress", "ingest_pages", "windowed_events"]
