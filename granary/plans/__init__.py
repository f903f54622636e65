"""Table builders (silver, gold), analyses and the jobs that run them."""
