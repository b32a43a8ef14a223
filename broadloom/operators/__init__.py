"""DataFrame-to-DataFrame operators and the distributed learners."""
