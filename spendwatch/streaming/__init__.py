"""Structured Streaming versions of the polling jobs (file sources,
``availableNow`` triggers, checkpointed, restartable)."""
