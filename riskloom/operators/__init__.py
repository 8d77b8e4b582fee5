"""DataFrame operators: cleaning, profiling, quantiles, splits, metrics, preprocessing, triage."""
