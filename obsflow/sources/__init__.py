"""Readers: files, feeds, reports and tables to DataFrames."""
