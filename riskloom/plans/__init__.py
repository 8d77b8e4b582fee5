"""End-to-end plans: training and benchmarking, exploratory analysis, bulk scoring and reports."""
