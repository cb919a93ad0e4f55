"""Dialogue-corpus engine on Spark."""
