"""Structured Streaming jobs.

The reference has no streaming operator; the one continuous job kept is
scoring newly arriving files with a fitted model (the batch scoring of
section L11 as a stream)."""
