"""Part of docgraph: operators."""
