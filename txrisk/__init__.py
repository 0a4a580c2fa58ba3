"""Transaction-risk analytics as plain ``DataFrame -> DataFrame`` functions."""
