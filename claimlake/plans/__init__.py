"""Stage runner, model-call relations and whole runs."""
