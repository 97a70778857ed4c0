"""Data preparation, quality and tabular modelling as plain Spark jobs."""

from tabulon.session import build_session, scratch_path, shared_folder

__all__ = ["build_session", "scratch_path", "shared_folder"]
__version__ = "0.1.0"
