"""Vendor and review analytics on Spark."""

from reviewloom.session import Workspace, build_session, materialize

__all__ = ["Workspace", "build_session", "materialize"]
