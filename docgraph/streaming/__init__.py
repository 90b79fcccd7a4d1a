"""Part of docgraph: streaming."""
