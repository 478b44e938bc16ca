"""Compositions of operators: the silver and gold tables and the jobs that write them."""
