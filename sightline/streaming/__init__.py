"""Structured Streaming: query starters, the stateful last-seen operator, pipelines."""
