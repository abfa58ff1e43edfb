"""Report parameters and the multi-section report."""
