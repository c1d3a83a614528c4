"""Where tables come from, how they are checked and where results go."""
