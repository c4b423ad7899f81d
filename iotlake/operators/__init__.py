"""DataFrame-to-DataFrame operators, for batches and streams alike."""
