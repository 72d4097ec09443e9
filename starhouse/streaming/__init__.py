"""Change feeds that arrive as a stream of files."""
