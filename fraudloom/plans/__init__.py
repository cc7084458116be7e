"""Whole jobs built from the operators: scoring, mart, KPIs, dashboard, health."""
