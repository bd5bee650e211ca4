"""The row-local operators on a stream."""
