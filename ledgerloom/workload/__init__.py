"""The library's operators applied to the test tables, with SQL for comparison."""
