"""quillspark: quantitative text analysis as plain Spark DataFrame functions.

Every public function takes DataFrames (and column names) and returns a
DataFrame. Nothing is collected to the driver; order-dependent steps carry
an explicit order key because Spark rows have no physical order.
"""

from quillspark.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
