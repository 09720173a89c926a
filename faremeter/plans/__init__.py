"""The registered queries, each bound to the star-schema tables."""
