"""Reading and writing: topic landing, message archive, layer tables."""
