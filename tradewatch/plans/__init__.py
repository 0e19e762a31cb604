"""Composite plans: the daily run over many days, and the query catalog."""
