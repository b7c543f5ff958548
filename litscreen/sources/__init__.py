"""Readers: files that land, CSV exports, Parquet tables, run state and saved models."""
