"""Logical plans of the warehouse tables, marts and composed jobs."""
