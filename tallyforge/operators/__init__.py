"""Table-to-table operators: features, profiles, contracts, drift, quality, preparation, training."""
