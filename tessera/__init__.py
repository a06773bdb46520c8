"""tessera: Spark-first data preparation, regression and classification jobs.

Everything runs as DataFrame/SQL plans; numpy is used only inside Arrow
batches (``mapInArrow``) or on small, size-bounded driver state such as a
d x d Gram matrix or a weight matrix.
"""

from tessera.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
