"""tidestar: change feeds in, star schema out, all as Spark plans."""

from tidestar.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
