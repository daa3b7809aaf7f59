"""DataFrame-to-DataFrame operators of each layer."""
