"""Whole flows: lab tables to run sheets, run sheets to queue, results to packages and releases."""
