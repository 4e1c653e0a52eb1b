"""Price-snapshot analytics as plain ``DataFrame -> DataFrame`` functions."""
