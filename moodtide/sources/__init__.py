"""Reading and writing: raw landing, layers, page payloads."""
