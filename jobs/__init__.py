"""Jobs that are run from the command line; the work of each is a function that takes a session."""
