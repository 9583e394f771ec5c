"""User-facing plans (the original scripts' entry points) and the query catalog."""
