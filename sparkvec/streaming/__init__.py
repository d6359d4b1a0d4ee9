"""The embedding job over files that keep arriving."""
