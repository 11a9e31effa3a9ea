"""Regional metric assembly on Spark DataFrames."""

from plumbline.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
