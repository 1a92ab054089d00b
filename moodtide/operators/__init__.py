"""Dataset operators, grouped by the layer they belong to."""
