"""Jobs that combine operators with table writes."""
