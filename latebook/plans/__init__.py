"""Jobs: landing to bronze, bronze to silver, silver to gold, and the streams."""
