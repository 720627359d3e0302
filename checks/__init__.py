"""Every operator run on the generated tables, each with the SQL that states the expected rows."""
