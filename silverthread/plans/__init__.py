"""The composite pipelines: pure builders, and runners that read and write."""
