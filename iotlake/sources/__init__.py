"""Readers: topics, replayed envelopes, lake tables and checkpoint folders."""
