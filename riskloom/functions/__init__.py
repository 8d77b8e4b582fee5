"""Column-expression functions: scalar helpers, disease recipes, intake projections, risk rules."""
