"""The record-file reader over a landing folder."""
