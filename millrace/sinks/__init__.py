"""Writers.  Each one can be handed the same micro-batch twice without harm."""
