"""Training-data operators; each module states its method, its defined edge cases and its bounds."""
