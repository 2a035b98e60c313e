"""Index building batch by batch."""
