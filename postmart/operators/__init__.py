"""Table-level operators: keys, dimensions, fact, bridge, quality, constraints, star."""
