"""Whole jobs over a lake: ingest, report, clean, build gold, check it, publish it."""
