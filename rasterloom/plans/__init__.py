"""Plans: operators put together, from packages to products."""
