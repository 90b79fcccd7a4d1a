"""Part of docgraph: plans."""
