"""Message sources."""
