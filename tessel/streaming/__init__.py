"""Stateful and streaming operators."""
