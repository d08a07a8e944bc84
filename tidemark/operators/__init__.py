"""Relational building blocks, each from DataFrame to DataFrame and lazy unless it says otherwise."""
