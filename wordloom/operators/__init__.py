"""DataFrame operators: tokens, dense IDs, postings, runs."""
