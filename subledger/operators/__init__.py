"""Reusable relational steps: dedup, rules, upsert, data quality, revenue movements, schedule."""
