"""File streams, windowed counts, sinks and stream scoring."""
