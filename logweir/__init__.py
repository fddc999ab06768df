"""Log-stream validation, service metrics, lag and dead-letter analytics on Spark."""
