"""Views, queries and oracle SQL over the provided tables."""
