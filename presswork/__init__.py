"""Spark-first analytics over news observations, collection events and page text."""
