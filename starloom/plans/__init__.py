"""Named models, their dependency order and the tool registry."""
