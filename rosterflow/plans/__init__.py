"""Table builders and the batch jobs that run them."""
