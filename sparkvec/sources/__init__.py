"""Reading documents and keeping vector stores in the catalog."""
