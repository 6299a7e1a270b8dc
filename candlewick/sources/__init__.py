"""Readers and writers: raw messages, the fixture mapping, the stored tables."""
