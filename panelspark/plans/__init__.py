"""Plans of panelspark."""
