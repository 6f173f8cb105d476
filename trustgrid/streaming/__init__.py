"""Structured Streaming entry points for the stateless cell parsers."""
