"""segmetric: customer segmentation and churn analytics as Spark jobs.

Every operator is a function from DataFrame to DataFrame or a Spark ML
Estimator/Model. Rows carry a stable ``row_id``; nothing relies on row order.
"""

from segmetric.session import ensure_checkpoint_dir, get_spark

__all__ = ["get_spark", "ensure_checkpoint_dir"]
