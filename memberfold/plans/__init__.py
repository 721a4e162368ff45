"""Complete jobs, runnable with spark-submit."""
