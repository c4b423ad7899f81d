"""Training-data operators on the text tables; nothing else in the library imports this subpackage."""
