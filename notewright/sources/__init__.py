"""Readers: record files, field catalogues, workbooks, nested payloads, vectors and folders."""
