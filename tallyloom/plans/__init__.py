"""Named queries over the test tables, with reference SQL."""
