"""Feature-table export, training, scoring and metrics as Spark jobs."""
