"""Sinks: CSV drops, stored tables with publish-after-check, JDBC (BI) loads."""
