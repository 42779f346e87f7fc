"""Incremental forms of run discovery and restriction."""
