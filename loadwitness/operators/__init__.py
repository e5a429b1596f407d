"""DataFrame operators: comparison, checks, run status, workflows, lookups, saved results."""
