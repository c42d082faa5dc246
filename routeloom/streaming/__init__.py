"""Structured streaming: the workflow has no streams, so there is nothing here yet."""
