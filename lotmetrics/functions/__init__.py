"""Part of the panel analytics library."""
