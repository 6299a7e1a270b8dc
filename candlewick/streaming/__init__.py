"""Structured Streaming jobs: windowed average, symbol dedupe, fan-out, relay."""
