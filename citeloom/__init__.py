"""Citation-graph analytics on PySpark: sources, functions, operators, plans and streaming."""

from citeloom.session import build_session, materialize, shared_dir

__all__ = ["build_session", "materialize", "shared_dir"]
