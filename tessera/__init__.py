"""tessera: a Spark-native medallion analytics library.

Bronze sources -> silver cleaning / identity / quality -> gold star schema,
relational + window analytics, nested-document operators, leakage-safe
feature tables and cross-validated regression, all as DataFrame operators.
"""

from tessera.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
