"""Shared column helpers: exact money sums, number and label text, top-n per key."""
