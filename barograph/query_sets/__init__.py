"""The operators as named queries, by family. Importing a module registers its queries."""
