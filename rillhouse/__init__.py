"""A layered real-time warehouse written as Spark DataFrame transformations.

``functions``  column expressions (time text, names, keywords, JSON)
``sources``    feeds, page logs, dictionaries, configuration tables
``operators``  DataFrame -> DataFrame building blocks
``plans``      the warehouse jobs, composed from the operators
``streaming``  the same jobs as Structured Streaming queries, and their sinks
"""

from rillhouse.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
