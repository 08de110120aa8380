"""Named feeds and the readers that open them, as batch or as stream."""
