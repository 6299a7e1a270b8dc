"""Operators of a training-data pipeline (see queries.py for their registered forms)."""
