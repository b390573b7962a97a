"""Reading, typing and writing the feeds."""
