"""The streaming jobs and their command lines."""
