"""Where catalogs come from and where predictions go."""
