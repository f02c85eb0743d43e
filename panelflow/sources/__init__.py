"""Sources: usage feeds, header feeds, file listings, archives, SQL."""
