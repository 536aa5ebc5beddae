"""DataFrame operators over records, files, vectors and answers."""
