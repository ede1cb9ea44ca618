"""Jobs (storage-touching compositions of operators) and the query registry."""
