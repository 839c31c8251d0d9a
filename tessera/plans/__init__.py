"""Staged relations, the feed job, the query registry and its oracle."""
