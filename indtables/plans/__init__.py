"""Plans: the SQL query surface and the bronze -> gold refresh."""
