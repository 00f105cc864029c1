"""Runnable jobs over the library's operators: each a function of a session, plain paths and a configuration."""
