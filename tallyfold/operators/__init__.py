"""DataFrame-to-DataFrame operators over cost facts and daily averages."""
