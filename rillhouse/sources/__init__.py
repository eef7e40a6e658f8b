"""Inputs: feeds, page logs, facts, dictionaries, configuration."""
