"""DataFrame-level operators (relational, stages, regression, classification)."""
