"""Jobs that tie operators together: land, build, publish, report."""
