"""Part of docgraph: functions."""
