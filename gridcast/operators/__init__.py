"""DataFrame → DataFrame operators: grids and fills (B, G), joins (C), aggregates (D), windows (E)."""
