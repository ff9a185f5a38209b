"""Plans that combine operators."""
