"""Queries over the test tables and the SQL that says what they must give."""
