"""Landing folder as a stream of arriving files."""
