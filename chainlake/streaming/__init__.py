"""Following the chain tip."""
