"""Sinks, start-up checks and progress of streaming queries."""
