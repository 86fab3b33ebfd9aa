"""Intermediate tables of the corpus operators: see txnlake.functions.store."""

from txnlake.functions.store import fresh, new_folder, release, shared_dir, written

__all__ = ["fresh", "new_folder", "release", "shared_dir", "written"]
