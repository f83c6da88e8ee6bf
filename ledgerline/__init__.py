"""ledgerline: Spark-native card-transaction risk analytics.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst plans each job end to end (pushdown, pruning,
codegen); I/O lives in ``sources`` and ``sinks`` only.
"""

__all__ = ["params", "schemas", "runtime"]
