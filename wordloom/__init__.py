"""Inverted indexes over crawled web pages, built as Spark DataFrame jobs."""
