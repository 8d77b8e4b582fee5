"""Sources and sinks: driver tables, patient panels, CSV files, artifacts."""
