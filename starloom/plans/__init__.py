"""Specs wired into the warehouse (car service + accidents), stand-in sources, full/incremental runs, queries."""
