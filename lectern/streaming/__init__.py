"""Streaming jobs. Each takes a streaming DataFrame and returns one."""
