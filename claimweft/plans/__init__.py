"""Jobs composed from operators, and the query registry with its SQL twins."""
