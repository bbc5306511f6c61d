"""Opinion analytics over comment tables, as composable DataFrame functions."""
