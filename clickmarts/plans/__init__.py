"""Mart compositions (M1-M5) and the incremental build."""
