"""tidemark: landed API pages to raw tables, models, measures and checks, on Spark."""

from tidemark.session import configure, get_session, shared_dir, written

__all__ = ["configure", "get_session", "shared_dir", "written"]
