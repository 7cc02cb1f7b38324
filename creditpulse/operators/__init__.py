"""DataFrame operators: routing, metric rules, roll-ups, as-of join, graph."""
