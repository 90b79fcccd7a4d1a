"""Part of docgraph: .."""
