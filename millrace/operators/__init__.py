"""DataFrame -> DataFrame operators.  Sizes, delays and bounds are arguments."""
