"""Named queries over the shared tables, each with the SQL that must give the same rows."""
