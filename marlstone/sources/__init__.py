"""Landing files, layer tables and the application's relational tables."""
