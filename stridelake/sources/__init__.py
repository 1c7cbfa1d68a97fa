"""File sources/sinks and the race-shaped fixture over the test tables."""
