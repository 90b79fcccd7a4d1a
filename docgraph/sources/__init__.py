"""Part of docgraph: sources."""
