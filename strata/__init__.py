"""strata: layered (raw → clean → star schema) e-commerce analytics on PySpark.

Every dataset is a plain ``DataFrame -> DataFrame`` function built from Spark's own
expressions, so the same code runs on batch and on streaming input. See README.md.
"""

from strata.session import build_session, scratch_dir, scratch_root

__all__ = ["build_session", "scratch_dir", "scratch_root"]
