"""Readers: lab tables, sheets, metadata, sample indexes, results, genotype files, file state."""
