"""Structured Streaming front end for captured pages."""
