"""Structured Streaming: quality as packages or lines arrive."""
