"""DataFrame -> DataFrame operators of the three record streams."""
