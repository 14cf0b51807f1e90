"""Every operator as a query on the test tables, each next to independent SQL."""
