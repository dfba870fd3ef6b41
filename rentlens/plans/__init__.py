"""Operators put together: ingestion, the market questions, the heavy workloads."""
